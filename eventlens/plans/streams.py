"""Registered queries that run a stream over the events table and return what its sink holds.

The table is the stream's source (Parquet files); a query runs until all of it
is processed, in a folder of its own below the run folder, and its
result is read back. Append-mode windows come out once the watermark has passed them: those that the
last event has closed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.time import epoch_s
from eventlens.plans.adapters import table
from eventlens.plans.catalog import query
from eventlens.session import run_folder
from eventlens.streaming import forms, sinks
from eventlens.streaming.runner import run_stream


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf.rstrip('/')}/events.parquet*"  # as a pattern: the table may be one file or a folder
    events = spark.readStream.schema(table(spark, sf, "events").schema).parquet(path)
    return events.withColumn("ts", F.timestamp_seconds(epoch_s("ts")))


def _views(spark, sf) -> DataFrame:
    return _stream(spark, sf).where(F.col("event_type").isin("view", "pv"))


def _run(spark) -> str:
    return f"{run_folder(spark)}/run-{uuid.uuid4().hex}"


def _closed_windows(out: DataFrame) -> DataFrame:
    """Final windows of an append-mode stream, by way of an exactly-once sink."""
    spark, run = out.sparkSession, _run(out.sparkSession)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema)
    run_stream(out, f"q{uuid.uuid4().hex}", checkpoint=f"{run}/checkpoint", foreach_batch=sinks.epoch_sink(f"{run}/out")).awaitTermination()
    return sinks.committed(spark, f"{run}/out", schema).drop("epoch")


@query
def stream_page_views_salted(spark, sf):
    """Page views per hour in two chained, salted stages of a stream."""
    return _closed_windows(forms.salted_count_stream(_views(spark, sf), "event_id"))


@query
def stream_uv_bitmap(spark, sf):
    """Visitors per hour from bitmap chunks in a stream's state."""
    return _closed_windows(forms.uv_bitmap_stream(_views(spark, sf)))


@query
def stream_unique_visitors(spark, sf):
    return _closed_windows(forms.unique_visitors_stream(_views(spark, sf)))


@query
def stream_sliding_count(spark, sf):
    """Events per type in sliding windows of a stream."""
    return _closed_windows(forms.windowed_count_stream(_stream(spark, sf), ["event_type"], "1 hour", "10 minutes"))


@query
def stream_sequence(spark, sf):
    """Events numbered in order over the micro-batches of a stream."""
    run = _run(spark)
    keep = sinks.epoch_sink(f"{run}/out")
    rows = _stream(spark, sf).select("event_id", "user_id")
    run_stream(rows, f"q{uuid.uuid4().hex}", checkpoint=f"{run}/checkpoint",
               foreach_batch=sinks.sequence_writer("event_id", keep, f"{run}/state")).awaitTermination()
    return sinks.committed(spark, f"{run}/out", "event_id long, user_id long, seq long").drop("epoch")


@query
def stream_routes(spark, sf):
    """Several outputs of one read: readings above and below 30 degrees, each to its own route."""
    run = _run(spark)
    rows = _stream(spark, sf).select("event_id", F.concat(F.lit("sensor_"), F.pmod("user_id", F.lit(12)).cast("string")).alias("id"), F.col("value").alias("temperature"))
    route = F.when(F.col("temperature") > 30, "high").when(F.col("temperature") <= 30, "low")
    run_stream(rows, f"q{uuid.uuid4().hex}", checkpoint=f"{run}/checkpoint", foreach_batch=sinks.epoch_sink(f"{run}/out", route)).awaitTermination()
    return sinks.committed(spark, f"{run}/out", "event_id long, id string, temperature double", routed=True).drop("epoch")
