"""Skew-safe running (prefix) aggregates per key in arrival order.

A plain ``Window.partitionBy(key).orderBy(order)`` sends every row of a key
to one task, so a key holding a third of the rows becomes a third of the
job in a single task. Prefix aggregates that combine associatively
(count, sum, max, min) are split in two phases instead:

1. rows are range-partitioned by the whole order tuple into buckets of about
   4M rows (inputs within one bucket take a plain single-pass window; without
   a key, where that would be one task, a bucket is a task's share from a few
   thousand rows on) and written once, with their bucket, to the shared
   checkpoint folder;
2. a running aggregate inside each (key, bucket) — parallel over buckets;
3. per-(key, bucket) totals (a grouped aggregate with map-side combine),
   then a running total over the buckets of a key — one row per bucket;
4. an equi-join on (key, bucket) adds the earlier buckets' total to each row.

The buckets' bounds are Spark's own sampled range bounds, in the sort order of
the tuple: NULLs, infinities, texts and dates fall where the window sorts them,
outliers take no space, and equal first columns are split by the tie-breaker.
Sampling moves bounds, never rows. The written table fixes every row's bucket,
so both branches and re-run tasks see the same ones, and the input is read once.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.time import to_col
from eventlens.session import materialized

ROWS_PER_BUCKET = 4_000_000  # ≈ 128–256 MB of rows per (key, bucket) task
KEYLESS_ROWS = 8192  # rows without a key that one task may take


def rows_per_bucket_default() -> int:
    """Target rows per (key, bucket) task; EVENTLENS_ROWS_PER_BUCKET overrides it
    (tests set it low to run the split plan on small fixtures)."""
    return int(os.environ.get("EVENTLENS_ROWS_PER_BUCKET", ROWS_PER_BUCKET))


BUCKET = "_pb"
BUCKETS_META = "eventlens.buckets"
ROWS_META = "eventlens.rows"


@dataclass(frozen=True)
class Prefix:
    """One prefix aggregate: kind in count/sum/max/min; inclusive frame or not."""
    kind: str
    col: object = None
    inclusive: bool = True


def _agg(kind: str, c) -> Column:
    if kind == "count":
        return F.count(F.lit(1) if c is None else to_col(c))
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](to_col(c))


def _reagg(kind: str, c: str) -> Column:
    """Aggregate of partial results of ``kind``."""
    return {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[kind](F.col(c))


def _merge(kind: str, prev: Column, local: Column) -> Column:
    if kind in ("count", "sum"):
        both_null = prev.isNull() & local.isNull()
        total = F.coalesce(prev, F.lit(0)) + F.coalesce(local, F.lit(0))
        if kind == "count":
            return total.cast("bigint")
        return F.when(both_null, F.lit(None)).otherwise(total)
    if kind == "max":
        return F.greatest(prev, local)
    return F.least(prev, local)


def with_range_bucket(df: DataFrame, order, rows_per_bucket: int | None = None, keyless: bool = False) -> DataFrame:
    """Add ``_pb``: a bucket, monotone in the ``order`` columns, of about
    ``rows_per_bucket`` rows, with the bucket count in the column metadata.

    Inputs within one target bucket get the constant 0. Rows of equal order
    tuples share a bucket. ``keyless`` deals the rows over all tasks.
    """
    rows_per_bucket = rows_per_bucket or rows_per_bucket_default()
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    n = df.count()
    if keyless:
        share = math.ceil(n / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows_per_bucket = min(rows_per_bucket, max(KEYLESS_ROWS, share))
    buckets = max(math.ceil(n / rows_per_bucket), 1)
    meta = {BUCKETS_META: buckets, ROWS_META: n}
    if buckets == 1:
        return df.select("*", F.lit(0).alias(BUCKET, metadata=meta))
    d = df.repartitionByRange(buckets, *[to_col(o) for o in order]).withColumn(BUCKET, F.spark_partition_id())
    # The table has no NULL bucket; files read back as nullable.
    out = materialized(d)
    return out.withColumn(BUCKET, F.coalesce(BUCKET, F.lit(0))).withMetadata(BUCKET, meta)


def input_rows(df: DataFrame) -> int | None:
    """Row count (or weight) of the input the carried ``_pb`` was built on."""
    if BUCKET not in df.columns:
        return None
    return df.schema[BUCKET].metadata.get(ROWS_META)


def bucket_count(df: DataFrame) -> int | None:
    """Bucket count recorded on a carried ``_pb`` column (None if absent)."""
    if BUCKET not in df.columns:
        return None
    return df.schema[BUCKET].metadata.get(BUCKETS_META)


def running_aggregates(df: DataFrame, keys: list, order: list, aggs: dict[str, Prefix],
                       bucket: Column | None = None, dealt: DataFrame | None = None) -> DataFrame:
    """Add one column per ``aggs`` entry: the aggregate over the key's rows
    up to (inclusive) or before (exclusive) each row in ``order``.

    ``order`` must be a total order within a key (carry a tie-breaker).
    ``bucket`` may be given when a monotone coarse order column exists.
    A ``_pb`` column already present (left by an earlier prefix stage over
    the same order columns) is reused, so chained stages do not
    re-run their upstream plan to find the span; the result keeps ``_pb``
    when it was present in the input. ``dealt`` are the rows of ``df``, with its
    ``_pb``, where ``repartitionById`` has put each bucket into the task of its number:
    rows then stay there, and only the totals travel.
    """
    keys = list(keys)
    order_cols = [to_col(o) for o in order]
    carried = BUCKET in df.columns
    if bucket is not None:
        d = df.withColumn(BUCKET, bucket)  # caller's bucket: always the split plan
    elif carried:
        d = df
    else:
        d = with_range_bucket(df, order, keyless=not keys)
    if bucket is None and bucket_count(d) == 1:
        return _single_pass(d, df, keys, order_cols, aggs, carried)
    d, kcols = _non_null_keys(d, keys)
    part = kcols + [BUCKET]
    # Local branch: rows shuffled once by (key, bucket), running aggregates per
    # bucket. Totals branch: a grouped aggregate with map-side combine, so it
    # shuffles one row per (key, bucket, map task) and recomputes only the
    # narrow projection it needs; the window is computed once. The equi-join
    # on the same non-null columns keeps the local partitioning.
    inc = Window.partitionBy(*part).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    exc = Window.partitionBy(*part).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    rows = d if dealt is None else _non_null_keys(dealt, keys)[0]
    local = rows.select("*", *[_agg(p.kind, p.col).over(inc if p.inclusive else exc).alias(f"_l_{n}")
                               for n, p in aggs.items()])
    totals = d.groupBy(*part).agg(*[_agg(p.kind, p.col).alias(f"_t_{n}") for n, p in aggs.items()])
    spec = Window.partitionBy(*kcols) if kcols else Window  # no key: one row per bucket in total
    before = spec.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(*part, *[_reagg(p.kind, f"_t_{n}").over(before).alias(f"_p_{n}")
                                    for n, p in aggs.items()])
    if dealt is not None:
        prefix = prefix.repartitionById(bucket_count(d), F.col(BUCKET))
    joined = local.join(prefix, on=part, how="inner")
    out = [F.col(c) for c in df.columns if c != BUCKET] + [F.col(BUCKET)] if carried else \
        [F.col(c) for c in df.columns]
    out += [_merge(p.kind, F.col(f"_p_{n}"), F.col(f"_l_{n}")).alias(n) for n, p in aggs.items()]
    return joined.select(*out)


def _non_null_keys(d: DataFrame, keys):
    """Grouping columns that are never NULL, so a plain equi-join on them keeps
    rows with NULL keys (as their own group) and reuses the partitioning."""
    cols = []
    for i, k in enumerate(keys):
        f = d.schema[k]
        if not f.nullable:
            cols.append(k)
            continue
        t = f.dataType.simpleString()
        if t == "string":
            dflt = F.lit("")
        elif t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal"):
            dflt = F.lit(0).cast(f.dataType)
        elif t == "boolean":
            dflt = F.lit(False)
        else:
            d = d.withColumn(f"_kv{i}", F.coalesce(F.to_json(F.struct(F.col(k))), F.lit("")))
            cols.append(f"_kv{i}")
            continue
        d = d.withColumn(f"_kv{i}", F.coalesce(F.col(k), dflt)).withColumn(f"_kn{i}", F.col(k).isNull())
        cols += [f"_kv{i}", f"_kn{i}"]
    return d, cols


def _single_pass(d: DataFrame, df: DataFrame, keys, order_cols, aggs, carried: bool) -> DataFrame:
    """One bucket: the running aggregates are plain window frames per key."""
    spec = Window.partitionBy(*keys) if keys else Window
    inc = spec.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    exc = spec.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(c) for c in df.columns if c != BUCKET]
    cols += [F.col(BUCKET)] if carried else []
    out = []
    for n, p in aggs.items():
        v = _agg(p.kind, p.col).over(inc if p.inclusive else exc)
        out.append((v.cast("bigint") if p.kind == "count" else v).alias(n))
    return d.select(*cols, *out)
