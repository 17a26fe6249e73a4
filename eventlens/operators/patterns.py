"""Strict-contiguity event patterns per key (``begin.next.next…within``).

A match is n consecutive rows of a key (event-time order) where row k
satisfies condition k and last.ts − first.ts < within. Conditions are
evaluated once per row; the rows k positions later are fetched by
equi-joins on (key, index + k) — bounded work per row, no per-key pass.
Overlapping matches are all emitted (no skip strategy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.operators.sequence import with_index, with_offsets


def match_sequence(df: DataFrame, key: str, ts: str, arrival: str, steps: list[Column],
                   within_s: float, carry=()) -> DataFrame:
    """Columns: key, first_<ts>, last_<ts>, matched (array of the n rows)."""
    n = len(steps)
    d = df.select(key, ts, arrival, *carry, *[c.alias(f"_c{k}") for k, c in enumerate(steps)])
    idx = with_index(d, key, [ts, arrival])
    nb = with_offsets(idx, key, [ts, arrival, *carry, *[f"_c{k}" for k in range(1, n)]],
                      list(range(1, n)))
    cond = F.col("_c0")
    for k in range(1, n):
        cond = cond & F.coalesce(F.col(f"_c{k}_n{k}"), F.lit(False))
    last_ts = F.col(f"{ts}_n{n - 1}") if n > 1 else F.col(ts)
    cond = cond & ((last_ts - F.col(ts)) < F.lit(within_s))

    def row(k):
        sfx = "" if k == 0 else f"_n{k}"
        return F.struct(F.col(f"{ts}{sfx}").alias(ts), F.col(f"{arrival}{sfx}").alias(arrival),
                        *[F.col(f"{c}{sfx}").alias(c) for c in carry])

    return nb.where(cond).select(key, F.col(ts).alias(f"first_{ts}"), last_ts.alias(f"last_{ts}"),
                                 F.array(*[row(k) for k in range(n)]).alias("matched"))


def match_times(df: DataFrame, key: str, ts: str, arrival: str, cond: Column, times: int,
                within_s: float, carry=()) -> DataFrame:
    """Quantifier ``times(n).consecutive().within(d)``: n consecutive rows all
    satisfying ``cond``."""
    return match_sequence(df, key, ts, arrival, [cond] * times, within_s, carry)


def select_match(matches: DataFrame, name: str = "events") -> DataFrame:
    """Pattern-select shape: ``matches`` = MAP(name → ARRAY<STRUCT>) next to the
    first / last matched rows."""
    return matches.select("*", F.create_map(F.lit(name), F.col("matched")).alias("matches"),
                          F.element_at("matched", 1).alias("first"),
                          F.element_at("matched", -1).alias("last"))


def login_fail_times(logins: DataFrame, times: int = 3, within_s: float = 3) -> DataFrame:
    """Warnings for ``times`` consecutive failed logins within ``within_s`` seconds."""
    m = match_times(logins, "user_id", "timestamp", "event_id", F.col("login_state") == "fail",
                    times, within_s)
    return m.select("user_id", F.col("first_timestamp").alias("first_fail_time"),
                    F.col("last_timestamp").alias("last_fail_time"),
                    F.concat(F.lit("login fail "), F.size("matched").cast("string"), F.lit(" times"))
                    .alias("warning_msg"))
