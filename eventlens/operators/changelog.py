"""Retract changelog of a continuously updated grouped aggregate.

For each input row of a key the updated result is emitted as ``+`` and,
if a previous result existed, it is first retracted as ``-`` — the
``(flag, row)`` stream a retracting table sink produces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators.prefix import Prefix, running_aggregates
from eventlens.operators.rolling import avg_half_up, beyond, exact
from eventlens.operators.topn import top_n_per_group


def changelog_count_avg(df: DataFrame, key: str, arrival: str, value: str) -> DataFrame:
    """Changelog of (count, avg) per key; ``value`` is any numeric column, NULLs count
    as rows but not in the average. Columns: key, arrival, op, cnt, avg_temp, seq
    (seq orders the two rows of one input: 0 retract, 1 insert)."""
    v, w = exact(F.col(value)), beyond(F.col(value))
    df = df.withColumns({"_v": F.coalesce(v, F.lit(0)), "_w": w, "_has": (v.isNotNull() | w.isNotNull()).cast("bigint")})
    # Sums before the row, and it added: a large value that is added does not blur what was before.
    r = running_aggregates(df, [key], [arrival], {
        "_n": Prefix("count"), "_k": Prefix("sum", "_has"), "_s": Prefix("sum", "_v"), "_r": Prefix("sum", "_w"), "_old": Prefix("sum", "_w", inclusive=False)})
    old_n, old_k = F.col("_n") - 1, F.col("_k") - F.col("_has")
    old_s = (F.col("_s") - F.col("_v")).cast("decimal(38,8)")
    retract = F.when(old_n > 0, F.struct(F.lit("-").alias("op"), old_n.alias("cnt"),
                                         avg_half_up(old_s, old_k, F.col("_old")).alias("avg_temp"),
                                         F.lit(0).alias("seq")))
    insert = F.struct(F.lit("+").alias("op"), F.col("_n").alias("cnt"),
                      avg_half_up(F.col("_s"), F.col("_k"), F.col("_r")).alias("avg_temp"),
                      F.lit(1).alias("seq"))
    ex = r.select(key, arrival, F.explode(F.array(retract, insert)).alias("_c"))
    return ex.where(F.col("_c").isNotNull()).select(key, arrival, "_c.op", "_c.cnt", "_c.avg_temp", "_c.seq")


def changelog_top_n(df: DataFrame, group: list, key: str, arrival: str, n: int = 5) -> DataFrame:
    """Changelog of a continuously updated top-n by count: every row adds one to
    the count of its ``key`` in its ``group``; whatever enters the first ``n``
    ranks, moves or leaves is retracted (``-``) and inserted (``+``) at the
    row's ``arrival`` (unique in a group). Ties go to the key that reached the count first.
    Columns: group, arrival, op, key, cnt, rn.

    No ranking is replayed. A key that reaches a count is ranked by how many
    reached it before; so at any count only the first ``n`` keys of a group
    matter. While it stays there, a key is passed by those that came to its
    count later and to the next one earlier than itself, again among the next
    count's first ``n``. Thus a row's ranks follow from two lists of at most
    ``n`` keys, (group, count) and (group, count + 1): a running count, a
    partial top-n and one grouping, spread over the counts of a hot group.
    """
    rows = df.select(*group, F.col(key).alias("_key"), F.col(arrival).alias("_at"))
    counted = running_aggregates(rows, [*group, "_key"], ["_at"], {"_cnt": Prefix("count")})
    first = top_n_per_group(counted, [*group, "_cnt"], ["_at"], n, "_o")
    entry = F.struct(F.col("_o").alias("o"), F.col("_key").alias("k"), F.col("_at").alias("at"))
    sent = first.select(*group, F.explode(F.array(F.struct(F.col("_cnt").alias("cnt"), F.lit(True).alias("own")),
                                                  F.struct((F.col("_cnt") - 1).alias("cnt"), F.lit(False).alias("own")))).alias("_to"), entry.alias("_e"))
    lists = sent.where("_to.cnt > 0").groupBy(*group, F.col("_to.cnt").alias("cnt")).agg(
        F.sort_array(F.collect_list(F.when(F.col("_to.own"), F.col("_e")))).alias("_here"),
        F.sort_array(F.collect_list(F.when(~F.col("_to.own"), F.col("_e")))).alias("_next"))
    y = lists.select(*group, "cnt", "_here", "_next", F.explode("_here").alias("_y"))
    y = y.withColumn("_left", F.expr("get(filter(_next, z -> z.k <=> _y.k), 0)"))
    passed = F.expr("""filter(_next, z -> NOT (z.k <=> _y.k) AND (_left IS NULL OR z.at < _left.at)
                                     AND NOT exists(_here, e -> e.k <=> z.k AND e.o < _y.o))""")
    y = y.withColumn("_passed", passed)
    # The key's stays at one rank each: until it is passed, or counts on.
    stays = F.expr(f"""transform(sequence(0, least(size(_passed), {int(n)} - _y.o)), j -> named_struct(
        'rn', _y.o + j, 'start', CASE WHEN j = 0 THEN _y.at ELSE get(_passed, j - 1).at END,
        'stop', CASE WHEN j < size(_passed) THEN get(_passed, j).at ELSE _left.at END))""")
    stay = y.select(*group, "cnt", F.col("_y.k").alias(key), F.explode(stays).alias("_s"))
    out = stay.select(*group, "cnt", key, F.col("_s.rn").cast("int").alias("rn"), F.explode(F.array(
        F.struct(F.lit("+").alias("op"), F.col("_s.start").alias("at")), F.struct(F.lit("-").alias("op"), F.col("_s.stop").alias("at")))).alias("_c"))
    return out.where("_c.at IS NOT NULL").select(*group, F.col("_c.at").alias(arrival), "_c.op", key, "cnt", "rn")
