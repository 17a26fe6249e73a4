"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(``id``, ``comp``) for every id of the links (``a``, ``b``): comp is the smallest id reachable.

    Each round hangs a node's larger neighbours, then its smaller ones, below
    its smallest neighbour; a logarithmic number of rounds ends in stars. A
    node's smallest neighbour is aggregated on the map side and joined back, so
    the neighbours of one node never meet in one task. Rounds are written to the
    shared folder, which bounds the lineage.
    """
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state.n == 0 or state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("a"), "m")
                 .unionByName(low.select(F.col("u").alias("a"), "m")))
        edges = written(small.select(F.greatest("a", "m").alias("u"), F.least("a", "m").alias("v")).where("u != v").distinct())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
