"""Stream splitting, side outputs, co-map and union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNROUTED = "unrouted"


def with_route(df: DataFrame, routes: dict[str, Column], col: str = "route") -> DataFrame:
    """Tag each row with the first route whose condition holds; rows for which
    no condition is true (e.g. a NULL measure) get ``unrouted``."""
    expr = None
    for name, cond in routes.items():
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(col, expr.otherwise(F.lit(UNROUTED)) if expr is not None else F.lit(UNROUTED))


def split_by(df: DataFrame, routes: dict[str, Column]) -> dict[str, DataFrame]:
    """Named outputs of one input (split + select). Each output is a filter of
    the same plan; Catalyst pushes each predicate to the scan."""
    return {name: df.where(cond) for name, cond in routes.items()}


def route_to(df: DataFrame, main: Column, side: dict[str, Column]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Process function with side outputs: (main output, {tag: side output})."""
    return df.where(main), {tag: df.where(c) for tag, c in side.items()}


def co_map(a: DataFrame, fa, b: DataFrame, fb) -> DataFrame:
    """Connect two inputs of different shapes; ``fa``/``fb`` map each to the
    common schema; the result is their UNION ALL by name."""
    return fa(a).unionByName(fb(b))


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL of same-typed inputs (duplicates kept)."""
    return reduce(lambda x, y: x.unionByName(y), dfs)


def map_routes(df: DataFrame, routes: dict[str, tuple[Column, list[Column]]]) -> DataFrame:
    """UNION ALL of mapped parts of one input, in a single pass: a row gives one
    output row for every route whose condition holds (two overlapping routes:
    two rows). ``routes`` maps a name to (condition, output columns); all routes
    name their columns alike, and types must match."""
    made = F.array(*[F.when(cond, F.struct(*cols)) for cond, cols in routes.values()])
    return df.select(F.explode(F.filter(made, lambda r: r.isNotNull())).alias("_r")).select("_r.*")
