"""Per-key element index and neighbour access without a per-key sequential pass.

``with_index`` numbers the rows of each key in order (two-phase prefix
count). Neighbours (previous / next k-th row of the same key) are then
equi-joins on (key, index ± k): the join key is unique, so a hot key is
spread evenly over all reducers. This replaces ``lag``/``lead`` over
``Window.partitionBy(key)``, which puts a whole key in one task.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators.prefix import BUCKET, Prefix, running_aggregates, with_range_bucket

IDX = "_idx"
BLK = "_blk"


def fan_block() -> int:
    """Indexes per block for local fan-out; EVENTLENS_FAN_BLOCK overrides it."""
    return int(os.environ.get("EVENTLENS_FAN_BLOCK", 4096))


def local_fan_out(df: DataFrame, keys, items, name: str = "_e") -> DataFrame:
    """Explode ``items`` (array of structs with a per-key index ``_t``) so that
    a later ``groupBy(*keys, BLK, <index>)`` needs no further shuffle.

    Each row is shuffled once to the (key, block) of its targets — twice
    only when its targets straddle a block boundary — and the copies are
    made inside those partitions: a fan-out of k copies costs ~1× the rows
    in network traffic instead of k×. Blocks hold ``fan_block()`` indexes of
    one key, so a hot key is spread over its blocks.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    b = F.lit(fan_block())
    blocks = F.array_distinct(F.transform(items, lambda e: F.call_function("div", e["_t"], b)))
    copies = df.withColumn("_items", items).select("*", F.explode(blocks).alias(BLK)).repartition(*keys, BLK)
    out = copies.select(*[c for c in copies.columns if c != "_items"], F.explode("_items").alias(name))
    return out.where(F.call_function("div", F.col(f"{name}._t"), b) == F.col(BLK))


def with_index(df: DataFrame, keys, order, name: str = IDX) -> DataFrame:
    """Adds ``name`` (1-based per key) and keeps the range bucket ``_pb`` so
    later prefix stages over the same order reuse it."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if BUCKET not in df.columns:
        df = with_range_bucket(df, order)
    return running_aggregates(df, keys, order, {name: Prefix("count")})


def _suffix(off: int) -> str:
    return f"p{-off}" if off < 0 else f"n{off}"


def with_offsets(indexed: DataFrame, keys, cols, offsets, idx: str = IDX) -> DataFrame:
    """Add ``<col>_p1`` (previous row), ``<col>_n1`` (next row), … per key.

    One bounded expansion: every row is sent to its own index and, for each
    offset k, to index − k (where it is the k-th neighbour); a group by
    (key, index) then holds the row and its neighbours — at most
    1 + len(offsets) rows. The copies are made after one shuffle by
    (key, index block) (``local_fan_out``). Missing neighbours are NULL.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    own = [c for c in indexed.columns if c not in keys and c != idx]
    payload = F.struct(*[F.col(c) for c in cols])
    roles = [F.struct(F.col(idx).alias("_t"), F.lit(0).alias("_r"),
                      F.struct(*[F.col(c) for c in own]).alias("_self"), payload.alias("_p"))]
    for off in offsets:
        roles.append(F.struct((F.col(idx) - F.lit(off)).alias("_t"), F.lit(off).alias("_r"),
                              F.lit(None).cast(indexed.select(F.struct(*[F.col(c) for c in own])).schema[0].dataType)
                              .alias("_self"), payload.alias("_p")))
    ex = local_fan_out(indexed.select(*keys, *[c for c in indexed.columns if c not in keys]), keys,
                       F.array(*roles))
    g = ex.groupBy(*keys, BLK, F.col("_e._t").alias(idx)).agg(
        F.max(F.when(F.col("_e._r") == 0, F.col("_e._self"))).alias("_self"),
        *[F.max(F.when(F.col("_e._r") == off, F.col("_e._p"))).alias(f"_nb{i}") for i, off in enumerate(offsets)])
    out = g.where(F.col("_self").isNotNull()).select(
        *keys, idx, *[F.col("_self").getField(c).alias(c, metadata=indexed.schema[c].metadata) for c in own],
        *[F.col(f"_nb{i}").getField(c).alias(f"{c}_{_suffix(off)}")
          for i, off in enumerate(offsets) for c in cols])
    return out.select(*indexed.columns, *[c for c in out.columns if c not in indexed.columns])
