"""Keyed timer rules as independent folds (batch form of a keyed process
function with one event-time timer).

Rule: per key in event-time order, an *item* row with no open alarm opens
one at its time f and arms a timer at f + delay; later items with
ts ≤ f + delay join it; a *reset* row (non-item) at ts ≤ f + delay
cancels it; otherwise the timer fires (emit when the alarm has at least
``min_items`` items) before the next row is handled. At equal times the
row is handled before the timer. The end of input fires open timers.

A reset, or an item more than ``delay`` after the previous item, closes
every open state, so the rows split into independent *segments*: maximal
chains of items with gaps ≤ delay and no reset in between. Segment ids
come from a two-phase prefix sum; segments are sorted and folded in one
linear pass a task; the row right after the segment
(its closer) decides whether the last alarm fires or is cancelled.
"""

from __future__ import annotations

import math
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.session import checkpoint_dir

from eventlens.operators.prefix import BUCKET, ROWS_PER_BUCKET, Prefix, input_rows, running_aggregates
from eventlens.operators.sequence import IDX, with_index, with_offsets


def timer_alarms(df: DataFrame, key: str, ts: str, arrival: str, item: str, delay: int,
                 min_items: int = 1) -> DataFrame:
    """Columns: key, first_ts, last_ts, n, fire_ts (= first_ts + delay)."""
    carry = [BUCKET] if BUCKET in df.columns else []
    base = df.select(key, ts, arrival, item, *carry)
    idx = with_index(base, key, [ts, arrival])
    nb = with_offsets(idx, key, [item, ts], [-1, 1])
    return fold_segments(nb, key, ts, arrival, F.col(item), F.col(f"{item}_p1"), F.col(f"{item}_n1"),
                         F.col(f"{ts}_p1"), F.col(f"{ts}_n1"), delay, min_items,
                         lambda: max_rows_per_key(base, key))


def max_rows_per_key(df: DataFrame, key: str) -> int:
    """Largest key's row count (a grouped count over the base input)."""
    return df.groupBy(key).count().agg(F.max("count")).first()[0] or 0


def fold_segments(nb: DataFrame, key: str, ts: str, arrival: str, item, item_prev, item_next,
                  ts_prev, ts_next, delay: int, min_items: int = 1, max_rows_per_key=None) -> DataFrame:
    """The fold over rows that already carry their neighbours' item flag and
    time (``item_prev``/``item_next`` NULL when there is no such row).
    ``max_rows_per_key`` (a callable giving an upper bound of any segment's
    length, read cheaply from the base input) skips measuring segments when
    none can exceed the fold chunk; an input no larger than the chunk skips
    both."""
    items = nb.select(key, ts, arrival, IDX, BUCKET, item_next.alias("_item_n"), ts_next.alias("_ts_n"),
                      (~F.coalesce(item_prev, F.lit(False))
                       | (F.col(ts) - ts_prev > F.lit(delay))).cast("int").alias("_start"),
                      item.alias("_item")).where(F.col("_item"))
    seg = running_aggregates(items, [key], [ts, arrival], {"_seg": Prefix("sum", "_start")})
    chunk = fold_chunk()
    longest = 0
    total = input_rows(nb)
    small = total is not None and total <= chunk
    if not small and (max_rows_per_key is None or max_rows_per_key() > chunk):
        seg = running_aggregates(seg, [key, "_seg"], [ts, arrival], {"_si": Prefix("count")})
        closer = F.struct(F.col("_item_n").alias("item"), F.col("_ts_n").alias("t"))
        lens = seg.groupBy(key, "_seg").agg(F.max("_si").alias("_len"), F.max_by(closer, "_si").alias("_closer"))
        longest = lens.agg(F.max("_len")).first()[0] or 0  # one statistics row
    if longest > chunk:
        with_len = seg.join(lens.select(key, "_seg", "_len"), [key, "_seg"])
        short_rows = with_len.where(F.col("_len") <= chunk)
        long_alarms = _long_segment_alarms(with_len.where(F.col("_len") > chunk), lens.where(F.col("_len") > chunk),
                                           key, ts, delay)
    else:
        short_rows, long_alarms = seg, None
    # Segments pass in order through a fold that holds one open alarm: linear, and nothing is gathered.
    rows = (short_rows.select(F.col(key).alias("k"), "_seg", F.col(ts).cast("long").alias("t"), F.col(arrival).alias("a"),
                              F.coalesce("_item_n", F.lit(False)).alias("item_n"), F.col("_ts_n").cast("long").alias("t_n"))
            .repartition("k", "_seg").sortWithinPartitions("k", "_seg", "t", "a").drop("a"))
    kind = short_rows.schema[key].dataType.simpleString()
    folded = rows.mapInArrow(_fold_sorted(delay), f"k {kind}, first_ts long, last_ts long, n int").withColumnRenamed("k", key)
    if long_alarms is not None:
        folded = folded.unionByName(long_alarms)
    return folded.where(F.col("n") >= min_items).withColumn("fire_ts", F.col("first_ts") + F.lit(delay))


def _fold_sorted(delay: int):
    """mapInArrow function over rows sorted by (key, segment, time) to the alarms that fire."""
    def run(batches):
        at = first = last = key = kind = None
        n, fires, out = 0, False, []
        for b in batches:
            kind = b.column(0).type
            for k, seg, t, item_n, t_n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != (k, seg):
                    if n and fires:
                        out.append((key, first, last, n))
                    at, key, first, n = (k, seg), k, t, 0
                elif t > first + delay:  # the timer goes off before this item
                    out.append((key, first, last, n))
                    first, n = t, 0
                last, n = t, n + 1
                # Whether the alarm fires if the segment ends here: the next row closes it.
                fires = t_n is None or item_n or t_n > first + delay
            yield _alarm_batch(out, kind)
            out = []
        if n and fires:
            yield _alarm_batch([(key, first, last, n)], kind)
    return run


def _alarm_batch(rows, kind) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                      names=["k", "first_ts", "last_ts", "n"])


def fold_chunk() -> int:
    """Longest segment that one task folds (a task's share of rows, see
    ``prefix``); longer segments take the exact parallel path.
    EVENTLENS_FOLD_CHUNK overrides it (tests)."""
    return int(os.environ.get("EVENTLENS_FOLD_CHUNK", ROWS_PER_BUCKET))


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder (cuts lineage of
    iterative plans; survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _long_segment_alarms(rows: DataFrame, lens: DataFrame, key: str, ts: str, delay: int) -> DataFrame:
    """Alarms of long segments without gathering a segment.

    With items 1..L of a segment in order, next(i) = first item later than
    t_i + delay (a rank: items with t ≤ t_i + delay, from a two-phase prefix
    count over items and probes). Alarm starts are the path 1, next(1),
    next(next(1)), … Jump tables next^(2^k) (k < ⌈log2(L+1)⌉) are built by
    self-joins, and the path is expanded from item 1 level by level — every
    step an equi-join, O(L log L) work, no group larger than one row per item.
    """
    seg = [key, "_seg"]
    base = rows.select(*seg, "_si", F.col(ts).alias("_t"), "_len")
    items = base.select(*seg, F.col("_t").alias("_pt"), F.lit(0).alias("_ty"), "_si", F.lit(1).alias("_one"))
    probes = base.select(*seg, (F.col("_t") + F.lit(delay)).alias("_pt"), F.lit(1).alias("_ty"), "_si",
                         F.lit(0).alias("_one"))
    ranked = running_aggregates(items.unionByName(probes), seg, ["_pt", "_ty", "_si"],
                                {"_cnt": Prefix("sum", "_one")})
    nxt = _cut(ranked.where(F.col("_ty") == 1).select(*seg, "_si", (F.col("_cnt") + 1).alias("_j")))

    longest = lens.agg(F.max("_len")).first()[0]
    levels = max(1, math.ceil(math.log2(longest + 1)))
    jumps = [nxt]
    for _ in range(1, levels):
        j = jumps[-1]
        hop = j.select(F.col(key).alias("_hk"), F.col("_seg").alias("_hs"), F.col("_si").alias("_mid"),
                       F.col("_j").alias("_j2"))
        two = j.join(hop, (F.col(key) == F.col("_hk")) & (F.col("_seg") == F.col("_hs"))
                     & (F.col("_j") == F.col("_mid")), "left")
        jumps.append(_cut(two.select(*seg, "_si", F.coalesce(F.col("_j2"), F.col("_j")).alias("_j"))))

    path = _cut(base.where(F.col("_si") == 1).select(*seg, "_si"))
    bound = lens.select(*seg, "_len")
    for j in reversed(jumps):
        step = path.join(j, [*seg, "_si"]).select(*seg, F.col("_j").alias("_si"))
        step = step.join(bound, seg).where(F.col("_si") <= F.col("_len")).select(*seg, "_si")
        path = _cut(path.unionByName(step))

    starts = path.join(nxt, [*seg, "_si"])  # _j: first item of the next alarm
    first = base.select(*seg, "_si", F.col("_t").alias("first_ts"))
    last = base.select(*seg, (F.col("_si") + 1).alias("_j"), F.col("_t").alias("last_ts"))
    alarms = starts.join(first, [*seg, "_si"]).join(last, [*seg, "_j"]).select(
        *seg, "_si", "first_ts", "last_ts", (F.col("_j") - F.col("_si")).alias("n"))
    final = alarms.groupBy(*seg).agg(F.max("_si").alias("_final"))
    c = F.col("_closer")
    fires = c["t"].isNull() | F.coalesce(c["item"], F.lit(False)) | (c["t"] > F.col("first_ts") + F.lit(delay))
    out = alarms.join(final, seg).join(lens.select(*seg, "_closer"), seg)
    keep = (F.col("_si") < F.col("_final")) | fires
    return out.where(keep).select(key, "first_ts", "last_ts", F.col("n").cast("int").alias("n"))


def login_fail_timer(logins: DataFrame, max_fails: int = 2, within_s: int = 2) -> DataFrame:
    """First failure arms a timer ``within_s`` later; a success cancels; at the
    timer ≥ ``max_fails`` failures give a warning.
    Columns: user_id, first_fail_time, last_fail_time, warning_msg."""
    d = logins.withColumn("_fail", F.col("login_state") == "fail")
    a = timer_alarms(d, "user_id", "timestamp", "event_id", "_fail", within_s, max_fails)
    return a.select("user_id", F.col("first_ts").alias("first_fail_time"),
                    F.col("last_ts").alias("last_fail_time"),
                    F.concat(F.lit("login fail "), F.col("n").cast("string")).alias("warning_msg"))


def rising_alarm(readings: DataFrame, interval_s: int = 10, key: str = "id", ts: str = "timestamp",
                 arrival: str = "event_id", value: str = "temperature", first_arms: bool = True) -> DataFrame:
    """A rise (value > previous value of the key) with no timer arms one
    ``interval_s`` later; a non-rise cancels it; when it fires the key rose
    continuously. Columns: id, armed_ts, fired_ts, warning_msg."""
    base = readings.select(key, ts, arrival, value)
    idx = with_index(base, key, [ts, arrival])
    nb = with_offsets(idx, key, [value, ts], [-2, -1, 1])
    t_p1 = F.col(f"{ts}_p1")
    v, v_p1, v_p2, v_n1 = (F.col(value), F.col(f"{value}_p1"), F.col(f"{value}_p2"), F.col(f"{value}_n1"))

    def rise(cur, prev, exists, has_prev):
        # the first reading of a key compares with "no previous value"; a NULL reading is no rise, nor is the one after it
        return F.when(~exists, F.lit(None)).when(~has_prev, F.lit(bool(first_arms))).otherwise(F.coalesce(cur > prev, F.lit(False)))

    a = fold_segments(nb, key, ts, arrival,
                      rise(v, v_p1, F.lit(True), t_p1.isNotNull()),
                      rise(v_p1, v_p2, t_p1.isNotNull(), F.col(f"{ts}_p2").isNotNull()),
                      rise(v_n1, v, F.col(f"{ts}_n1").isNotNull(), F.lit(True)),
                      F.col(f"{ts}_p1"), F.col(f"{ts}_n1"), interval_s, 1,
                      lambda: max_rows_per_key(base, key))
    return a.select(key, F.col("first_ts").alias("armed_ts"), F.col("fire_ts").alias("fired_ts"),
                    F.concat(F.lit("sensor "), F.col(key), F.lit(f" rose continuously for {interval_s}s"))
                    .alias("warning_msg"))
