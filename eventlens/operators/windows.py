"""Event-time window assigners and window aggregates.

Windows are epoch-aligned and half-open ``[start, end)``; every output
carries ``window_end`` = exclusive end in epoch ms.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.time import interval_ms, ms_to_spec, window_end_ms
from eventlens.operators.rolling import beyond, exact, exact_sum
from eventlens.session import materialized

# window ends per block (in units of the window size) for the pane strategy
BLOCK_WINDOWS = 8

LAID_OUT_ROWS = 1_000_000  # rows per (keys, window end) that one task makes and its consumers may sort


def laid_out_rows() -> int:
    """Laid-out rows per task; EVENTLENS_LAID_OUT_ROWS overrides it (tests set it low to deal small fixtures)."""
    return int(os.environ.get("EVENTLENS_LAID_OUT_ROWS", LAID_OUT_ROWS))


def _spec(x) -> str:
    return ms_to_spec(interval_ms(x))


def tumbling(df: DataFrame, time_col: str, size, keys=(), aggs=(), end_col: str = "window_end") -> DataFrame:
    """groupBy(tumbling window, keys).agg(aggs) with ``window_end`` in ms."""
    g = df.groupBy(F.window(F.col(time_col), _spec(size)).alias("window"), *keys)
    return _with_end(g.agg(*aggs), keys, end_col)


def sliding(df: DataFrame, time_col: str, size, slide, keys=(), aggs=(), end_col: str = "window_end") -> DataFrame:
    """groupBy(sliding window, keys).agg(aggs): every row lands in size/slide windows."""
    g = df.groupBy(F.window(F.col(time_col), _spec(size), _spec(slide)).alias("window"), *keys)
    return _with_end(g.agg(*aggs), keys, end_col)


def _with_end(agg: DataFrame, keys, end_col: str) -> DataFrame:
    key_names = [k if isinstance(k, str) else None for k in keys]
    rest = [c for c in agg.columns if c != "window" and c not in key_names]
    return agg.select(*[c for c in key_names if c], window_end_ms("window").alias(end_col), *rest)


def sliding_count(df: DataFrame, time_col: str, size, slide, keys=(), strategy: str = "panes",
                  count_col: str = "cnt", end_col: str = "window_end") -> DataFrame:
    """Count per (keys, sliding window).

    ``direct``: Spark's window assigner expands every row into size/slide
    windows before aggregating. ``panes``: count per pane
    (gcd(size, slide)) first — a combinable partial aggregate, so the
    fan-out applies to pane counts rather than rows — then sum the panes
    of each window. Same result; the pane form shuffles at most one row
    per (key, pane) into the windowing step. With slide > size the windows
    leave gaps, and rows in a gap count nowhere (panes only: Spark's
    assigner has no such windows).
    """
    if strategy == "direct" and interval_ms(slide) <= interval_ms(size):
        return sliding(df, time_col, size, slide, keys, [F.count(F.lit(1)).alias(count_col)], end_col)
    size_ms, slide_ms = interval_ms(size), interval_ms(slide)
    pane_ms = math.gcd(size_ms, slide_ms)
    pane = F.floor(F.unix_millis(F.col(time_col).cast("timestamp")) / F.lit(pane_ms)).cast("bigint")
    panes = df.groupBy(pane.alias("_pane"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    # windows containing pane [P, P + pane): starts s (multiples of slide) with
    # P + pane - size <= s <= P; the window end is s + size. Epoch-ms values
    # are exact in DOUBLE, so ceil/floor of the quotients are exact.
    p_ms = F.col("_pane") * F.lit(pane_ms)
    lo = F.ceil((p_ms + F.lit(pane_ms - size_ms)).cast("double") / F.lit(float(slide_ms))).cast("bigint")
    hi = F.floor(p_ms.cast("double") / F.lit(float(slide_ms))).cast("bigint")
    if slide_ms > size_ms:  # a pane in the gap between two windows is in none
        panes = panes.where(lo <= hi)
    if strategy == "panes_shuffle":
        ends = panes.select(*keys, "_n", F.explode(F.sequence(lo, hi)).alias("_s"))
        g = ends.groupBy(*keys, (F.col("_s") * F.lit(slide_ms) + F.lit(size_ms)).alias(end_col))
        return g.agg(F.sum("_n").cast("bigint").alias(count_col))
    end = lambda x: x * F.lit(slide_ms) + F.lit(size_ms)
    ranges = panes.select(*keys, "_n", end(lo).alias("_lo"), end(hi).alias("_hi"))
    return counts_of_ranges(ranges, keys, "_lo", "_hi", size, slide, count_col, end_col, rows=df)


def counts_of_ranges(ranges: DataFrame, keys, lo: str, hi: str, size, slide, count_col: str = "cnt",
                     end_col: str = "window_end", rows: DataFrame | None = None) -> DataFrame:
    """Sum of ``_n`` per (keys, window end) over ranges of window ends, ``lo`` to ``hi`` by ``slide``.

    A range is sent to the one or two blocks of ends that it touches. There it adds ``_n`` at its first end and
    takes it off after its last; the running sum over a key's changes holds until the next one, so rows are laid
    out without a table of them, and never shuffled. Hash(key, block) spreads a hot key over its blocks.

    What follows may sort a task's rows, so where there are more than ``laid_out_rows()``, the ranges are written
    once and dealt by (block, key) to as many tasks as keep each near that number: a task has few blocks and, of
    these, neighbouring keys, so a limit per window end leaves few rows of it. ``rows``, from which ``ranges`` was
    counted, tells without a write if there are few.
    """
    keys, step, block = list(keys), interval_ms(slide), interval_ms(size) * BLOCK_WINDOWS
    fan = max(interval_ms(size) // step, 1)
    of = lambda c: F.floor(F.col(c).cast("double") / float(block)).cast("bigint")
    few = max(laid_out_rows() // fan, 1)
    tasks = 1
    if rows is None or rows.limit(few + 1).count() > few:
        ranges = materialized(ranges)
        tasks = math.ceil(ranges.count() / few)
    sent = ranges.select(*keys, "_n", F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), F.explode(F.sequence(of(lo), of(hi))).alias("_blk"))
    sent = sent.repartitionByRange(tasks, "_blk", *keys) if tasks > 1 else sent.repartition(*keys, "_blk")
    # First and last end of the block: window ends are a multiple of the step past ``_lo``.
    start, stop = F.col("_blk") * F.lit(block), (F.col("_blk") + 1) * F.lit(block)
    begin = F.greatest("_lo", start + F.pmod(F.col("_lo") - start, F.lit(step)))
    after = F.least(F.col("_hi") + F.lit(step), stop + F.pmod(F.col("_lo") - stop, F.lit(step)))
    turns = F.array(F.struct(begin.alias("at"), F.col("_n").alias("d")), F.struct(after.alias("at"), (-F.col("_n")).alias("d")))
    turns = sent.select(*keys, "_blk", F.explode(turns).alias("_t")).select(*keys, "_blk", F.col("_t.at").alias("_at"), F.col("_t.d").alias("_d"))
    w = Window.partitionBy(*keys, "_blk").orderBy("_at")
    held = turns.select(*keys, "_at", F.lead("_at").over(w).alias("_next"),
                        F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint").alias(count_col))
    held = held.where((F.col(count_col) > 0) & (F.col("_at") < F.col("_next")))
    return held.select(*keys, F.explode(F.sequence(F.col("_at"), F.col("_next") - F.lit(step), F.lit(step))).alias(end_col), count_col)


def window_min_by(df: DataFrame, time_col: str, size, keys, value: str, arrival: str,
                  carry=(), end_col: str = "window_end") -> DataFrame:
    """Whole row of the minimum ``value`` per (keys, tumbling window); ties → first arrival.

    min(struct(value, arrival, ...)) is a combinable aggregate, so it keeps
    map-side partial aggregation (unlike collecting the window's rows).
    """
    st = F.min(F.struct(F.col(value), F.col(arrival), *[F.col(c) for c in carry])).alias("_m")
    g = df.groupBy(F.window(F.col(time_col), _spec(size)).alias("window"), *keys).agg(st)
    return g.select(*keys, window_end_ms("window").alias(end_col),
                    *[F.col("_m").getField(c).alias(c) for c in (arrival, *carry, value)])


def window_sum_keep_first(df: DataFrame, time_col: str, size, keys, value: str, arrival: str,
                          carry=(), sum_col: str | None = None, end_col: str = "window_end") -> DataFrame:
    """sum(value) per (keys, tumbling window); the other fields are the first arrival's.
    Floating values are summed exactly (eight places; those of 10^30 and more as doubles), others in their own type."""
    floating = df.schema[value].dataType.simpleString() in ("float", "double")
    total = exact_sum(F.sum(exact(F.col(value))), F.sum(beyond(F.col(value)))) if floating else F.sum(value)
    first = F.min(F.struct(F.col(arrival), *[F.col(c) for c in carry])).alias("_f")
    g = df.groupBy(F.window(F.col(time_col), _spec(size)).alias("window"), *keys).agg(
        total.alias("_s"), first)
    return g.select(*keys, window_end_ms("window").alias(end_col),
                    *[F.col("_f").getField(c).alias(c) for c in (arrival, *carry)],
                    F.col("_s").alias(sum_col or value))
