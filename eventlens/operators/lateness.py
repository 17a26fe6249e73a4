"""Deterministic model of event-time lateness for batch data.

Rows are processed in *arrival* order. Before row r the watermark is
max(event time of all rows that arrived earlier) − delay. A row is late
for a tumbling window when end − 1 ms + allowed_lateness ≤ that
watermark: the window has been purged and the row goes to the late
(side) output. Rows behind the watermark but within the allowed lateness
still update their window (the window re-fires with the corrected count).

The running max over the global arrival order is computed in two phases
(per-arrival-bucket max, prefix over buckets, local running max), never
as one unpartitioned window.

Sliding windows: a row belongs to several windows and is late only if all of
them are purged; otherwise it counts in those still open. These are the later
ones, so a row's open windows are one range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import interval_ms
from eventlens.operators.prefix import Prefix, running_aggregates
from eventlens.operators.windows import counts_of_ranges
from eventlens.session import materialized


def mark_late(df: DataFrame, ts_ms: str, arrival: list, size, delay, allowed_lateness=0) -> DataFrame:
    """Adds window_end (ms), watermark (ms, NULL before the first row),
    behind (ts < watermark) and late (window purged)."""
    size_ms, delay_ms, late_ms = interval_ms(size), interval_ms(delay), interval_ms(allowed_lateness)
    r = running_aggregates(df, [], arrival, {"_maxts": Prefix("max", ts_ms, inclusive=False)})
    wm = F.col("_maxts") - F.lit(delay_ms)
    end = (F.floor(F.col(ts_ms) / F.lit(size_ms)) + 1).cast("bigint") * F.lit(size_ms)
    return r.select(*[c for c in df.columns], end.alias("window_end"), wm.alias("watermark"),
                    F.coalesce(F.col(ts_ms) < wm, F.lit(False)).alias("behind"),
                    F.coalesce(end - 1 + F.lit(late_ms) <= wm, F.lit(False)).alias("late"))


def mark_late_sliding(df: DataFrame, ts_ms: str, arrival: list, size, slide, delay, allowed_lateness=0) -> DataFrame:
    """Adds ``open_from`` and ``open_to`` (ms, first and last window end the row still counts in; equal to its
    windows' range if none is purged), ``due_from`` (ms, first window end that has not fired before the row),
    ``late`` (all its windows are purged) and ``newest`` (its time is above all before it). ``slide`` ≤ ``size``."""
    size_ms, slide_ms = interval_ms(size), interval_ms(slide)
    delay_ms, late_ms = interval_ms(delay), interval_ms(allowed_lateness)
    if slide_ms > size_ms:
        raise ValueError("slide must not exceed size")
    r = running_aggregates(df, [], arrival, {"_maxts": Prefix("max", ts_ms, inclusive=False)})
    up = lambda x: F.ceil(x.cast("double") / float(slide_ms)).cast("bigint") * slide_ms
    t = F.col(ts_ms)
    last = F.floor(t.cast("double") / float(slide_ms)).cast("bigint") * slide_ms + size_ms
    first = up(t + 1 - size_ms) + size_ms
    # Open means end - 1 + allowed > watermark; window ends are size past a multiple of slide.
    still = up(F.col("_maxts") - delay_ms - late_ms + 2 - size_ms) + size_ms
    due = up(F.col("_maxts") - delay_ms + 2 - size_ms) + size_ms
    return r.select(*df.columns, F.greatest(first, still).alias("open_from"), last.alias("open_to"),
                    F.greatest(first, due).alias("due_from"), F.coalesce(still > last, F.lit(False)).alias("late"),
                    F.coalesce(t > F.col("_maxts"), F.lit(True)).alias("newest"))


def corrected_counts(marked: DataFrame, keys: list, size, slide, count_col: str = "cnt") -> DataFrame:
    """Final count per (keys, sliding window) of rows marked by ``mark_late_sliding``: what the last
    correction of each window says. Rows combine by their range of windows before the fan-out."""
    ranges = marked.where(~F.col("late")).groupBy(*keys, "open_from", "open_to").agg(F.count(F.lit(1)).alias("_n"))
    return counts_of_ranges(ranges, keys, "open_from", "open_to", size, slide, count_col)


def first_reaching(instants: DataFrame, at: str, rows: DataFrame, value: str, carry: list) -> DataFrame:
    """``instants`` with the ``carry`` columns of the row of the smallest ``value`` that is ``at`` or more
    (NULL if there is none): one merge of both sides in descending order, and a running minimum over it."""
    hit = F.struct(F.col(value).alias("v"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    known = rows.select((-F.col(value)).alias("_desc"), F.lit(0).alias("_side"), hit.alias("_row"), *[F.lit(None).cast(instants.schema[c].dataType).alias(c) for c in instants.columns])
    asked = instants.select((-F.col(at)).alias("_desc"), F.lit(1).alias("_side"), F.lit(None).cast(known.schema["_row"].dataType).alias("_row"), *instants.columns)
    merged = running_aggregates(known.unionByName(asked), [], ["_desc", "_side"], {"_hit": Prefix("min", "_row")})
    return merged.where("_side = 1").select(*instants.columns, *[F.col("_hit").getField(f"c{i}").alias(c) for i, c in enumerate(carry)])


def window_firings(df: DataFrame, marked: DataFrame, keys: list, ts_ms: str, arrival: list, size, slide, delay, count_col: str = "cnt") -> DataFrame:
    """Every firing of every (keys, sliding window): the row whose arrival fires it, the count it emits then and its number.

    ``df`` are all rows, marked by ``mark_late_sliding``, which move the watermark; ``marked`` those of them that
    are counted. A window fires when the watermark passes its end, and again at every later row it still takes.
    Windows that are open at the end of the input fire there (NULL arrival). Columns: keys, window_end, arrival, cnt, firing.
    """
    step = interval_ms(slide)
    newest = materialized(df.where("newest").select(ts_ms, *arrival))
    counted = materialized(marked.where(~F.col("late")).select(*keys, *arrival, "open_from", "open_to", "due_from"))
    in_time = counted.where("due_from <= open_to").groupBy(*keys, "due_from", "open_to").agg(F.count(F.lit(1)).alias("_n"))
    first = counts_of_ranges(in_time, keys, "due_from", "open_to", size, slide, "_n")
    ends = in_time.select("due_from", "open_to").distinct().select(F.explode(F.sequence("due_from", "open_to", F.lit(step))).alias("window_end")).distinct()
    asked = ends.withColumn("_at", F.col("window_end") - 1 + interval_ms(delay))
    fired = first_reaching(materialized(asked), "_at", newest, ts_ms, arrival).drop("_at")
    first = first.join(fired, "window_end")
    behind = counted.withColumn("_to", F.least("open_to", F.col("due_from") - step)).where("open_from <= _to")
    again = behind.select(*keys, *arrival, F.explode(F.sequence("open_from", "_to", F.lit(step))).alias("window_end"), F.lit(1).cast("bigint").alias("_n"))
    both = materialized(first.select(*again.columns).unionByName(again))
    out = running_aggregates(both, [*keys, "window_end"], arrival, {count_col: Prefix("sum", "_n"), "firing": Prefix("count")})
    return out.select(*keys, "window_end", *arrival, count_col, "firing")


def split_late(df: DataFrame, ts_ms: str, arrival: list, size, delay, allowed_lateness=0):
    """(on_time, late) outputs of a tumbling-window aggregation input."""
    m = mark_late(df, ts_ms, arrival, size, delay, allowed_lateness)
    return m.where(~F.col("late")), m.where(F.col("late"))
