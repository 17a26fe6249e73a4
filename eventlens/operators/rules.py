"""Keyed pairwise rules over consecutive rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators.sequence import with_index, with_offsets


def jump_alarm(df: DataFrame, key: str, arrival: str, value: str, threshold: float = 10.0) -> DataFrame:
    """Rows whose ``value`` differs from the key's previous value by ≥ threshold.

    Columns: key, arrival, last_<value>, <value>. Every reading updates the
    last value (the first reading of a key only stores it).
    """
    idx = with_index(df.select(key, arrival, value), key, [arrival])
    nb = with_offsets(idx, key, [value], [-1])
    prev = F.col(f"{value}_p1")
    return nb.where(prev.isNotNull() & (F.abs(F.col(value) - prev) >= F.lit(threshold))).select(
        key, arrival, prev.alias(f"last_{value}"), value)


def login_fail_pairs(logins: DataFrame, within_s: int = 2, key: str = "user_id",
                     ts: str = "timestamp", arrival: str = "event_id") -> DataFrame:
    """Two consecutive failures of a user at most ``within_s`` apart (a
    success in between resets). Event-time order, ties by arrival.
    Columns: user_id, first_fail_time, last_fail_time, warning_msg."""
    idx = with_index(logins.select(key, ts, arrival, "login_state"), key, [ts, arrival])
    nb = with_offsets(idx, key, ["login_state", ts], [-1])
    hit = ((F.col("login_state") == "fail") & (F.col("login_state_p1") == "fail")
           & (F.col(ts) - F.col(f"{ts}_p1") <= F.lit(within_s)))
    return nb.where(hit).select(key, F.col(f"{ts}_p1").alias("first_fail_time"),
                                F.col(ts).alias("last_fail_time"),
                                F.lit("login fail").alias("warning_msg"))
