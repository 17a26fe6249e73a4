"""Partition control: the exchange kinds of a keyed dataflow as Spark repartitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import to_col


def partition_by(df: DataFrame, strategy: str, n: int, key=None, seed: int = 42) -> DataFrame:
    """strategy:
    * ``hash``   — hash of ``key`` (keyBy);
    * ``shuffle``— random, seeded (uniform spread);
    * ``rebalance`` — round robin;
    * ``global`` — everything in one partition (does not scale; small data only);
    * ``custom`` — partition id = pmod(key, n) for an integral ``key`` expression.
    """
    if strategy == "hash":
        return df.repartition(n, to_col(key))
    if strategy == "shuffle":
        return df.repartition(n, F.rand(seed))
    if strategy == "rebalance":
        return df.repartition(n)
    if strategy == "global":
        return df.repartition(1)
    if strategy == "custom":
        return df.repartitionById(n, F.pmod(to_col(key), F.lit(n)).cast("int"))
    raise ValueError(f"unknown strategy {strategy!r}")


def with_partition_id(df: DataFrame, col: str = "part") -> DataFrame:
    return df.withColumn(col, F.spark_partition_id())
