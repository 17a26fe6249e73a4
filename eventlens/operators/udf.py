"""User-function surfaces: rich map with a lifecycle, custom aggregates, reduce.

Built-in column expressions are preferred everywhere; these exist for user
code that cannot be written as expressions. All are Arrow-batched.
"""

from __future__ import annotations

import os
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.operators.prefix import BUCKET
from eventlens.operators.sequence import IDX, with_index


def map_partitions_with_setup(df: DataFrame, fn: Callable[[pd.DataFrame, object], pd.DataFrame],
                              schema: str, setup: Callable[[], object] | None = None,
                              teardown: Callable[[object], None] | None = None) -> DataFrame:
    """Rich map: ``setup()`` once per task (open), ``fn(batch, ctx)`` per Arrow
    batch, ``teardown(ctx)`` at the end even on failure (close)."""

    def run(batches):
        ctx = setup() if setup else None
        try:
            for pdf in batches:
                yield fn(pdf, ctx)
        finally:
            if teardown:
                teardown(ctx)

    return df.mapInPandas(run, schema)


def agg_chunk() -> int:
    """Rows (or partial results) folded together in one group; env
    EVENTLENS_AGG_CHUNK overrides it (tests use tiny chunks)."""
    return int(os.environ.get("EVENTLENS_AGG_CHUNK", 10_000))


def _fold_levels(indexed: DataFrame, keys, start_of, step, finish) -> DataFrame:
    """Fold each key's values in index order, at most ``agg_chunk()`` values
    per group: level 1 folds chunks of rows, later levels fold chunks of
    partial results, until one remains per key. The number of levels comes
    from the largest key (one statistics row)."""
    c = agg_chunk()
    n_max = indexed.groupBy(*keys).agg(F.max(IDX).alias("m")).agg(F.max("m")).first()[0] or 0
    cur = indexed.select(*keys, F.call_function("div", F.col(IDX) - 1, F.lit(c)).alias("_c"),
                         (F.col(IDX) - 1).alias("_o"), F.col("_v"))
    level, span = 0, 1
    while True:
        vals = F.transform(F.sort_array(F.collect_list(F.struct("_o", "_v"))), lambda s: s["_v"])
        cur = cur.groupBy(*keys, "_c").agg(start_of(vals, level).alias("_v"))
        span *= c
        if span >= n_max:
            break
        level += 1
        cur = cur.select(*keys, F.call_function("div", F.col("_c"), F.lit(c)).alias("_c"),
                         F.col("_c").alias("_o"), "_v")
    return cur.select(*keys, finish(F.col("_v")).alias("result"))


def keyed_aggregate(df: DataFrame, keys, value: Column, zero: Column,
                    add: Callable[[Column, Column], Column],
                    merge: Callable[[Column, Column], Column],
                    result: Callable[[Column], Column] | None = None,
                    order: list | None = None) -> DataFrame:
    """User aggregate function (create = ``zero``, add, merge, getResult) per key.

    Rows are numbered per key (``order`` = a total order; default: all
    columns of ``value``'s row) and folded with ``add`` in chunks of at most
    ``agg_chunk()`` rows; chunk accumulators are combined with ``merge``
    level by level. ``zero`` must be neutral for ``merge``. No key's rows
    are ever gathered in one place.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = order or [c for c in df.columns if c not in keys]
    idx = with_index(df.select(*keys, *order, value.alias("_v")), keys, order).drop(BUCKET)

    def start_of(vals, level):
        return F.aggregate(vals, zero, add if level == 0 else merge)

    return _fold_levels(idx, keys, start_of, None, result or (lambda a: a))


def keyed_reduce(df: DataFrame, keys, order, value: Column, fn: Callable[[Column, Column], Column]) -> DataFrame:
    """Reduce each key's values in ``order`` with ``fn`` (must be associative,
    as incremental reduction assumes); chunked like ``keyed_aggregate``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    idx = with_index(df.select(*keys, *order, value.alias("_v")), keys, order).drop(BUCKET)

    def start_of(vals, level):
        return F.aggregate(F.slice(vals, 2, F.greatest(F.size(vals) - 1, F.lit(0))), F.element_at(vals, 1), fn)

    return _fold_levels(idx, keys, start_of, None, lambda a: a)
