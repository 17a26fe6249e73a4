"""Sinks: console printing, labelled output and send counters.

Topic sinks live in ``eventlens.sources.topic``; streaming output modes and
checkpoints in ``eventlens.streaming.runner``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def labelled(df: DataFrame, label: str | None = None, with_subtask: bool = False) -> DataFrame:
    """Rows as printed text: ``[label> ][subtask> ]row`` (subtask = 1-based
    partition, like a parallel print sink)."""
    body = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    parts = []
    if label:
        parts.append(F.lit(label + ">"))
    if with_subtask:
        parts.append(F.concat((F.spark_partition_id() + 1).cast("string"), F.lit(">")))
    parts.append(body)
    return df.select(F.concat_ws(" ", *parts).alias("value"))


def to_console(df: DataFrame, label: str | None = None, n: int = 20, truncate: bool = False):
    """Print a batch (``show``) or start a console streaming query."""
    if df.isStreaming:
        out = labelled(df, label) if label else df
        return out.writeStream.format("console").option("truncate", str(truncate).lower()).start()
    (labelled(df, label) if label else df).show(n, truncate=truncate)
    return None


def with_metrics(df: DataFrame, name: str, ok: F.Column | None = None) -> tuple[DataFrame, Observation]:
    """Count sent rows and failures (rows where ``ok`` is false) as observed
    metrics, collected as a side effect of the next action."""
    obs = Observation(name)
    good = ok if ok is not None else F.lit(True)
    observed = df.observe(obs, F.count(F.lit(1)).alias("sent"),
                          F.count_if(~good).alias("errors"))
    return observed, obs
