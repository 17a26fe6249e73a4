"""Sinks for micro-batches: committed epochs with routes, numbered rows, counters.

A micro-batch may run again after a failure. What it wrote first must then not
count, or count once: every sink here writes a batch under its epoch, makes it visible by
one small commit afterwards, and gives a repeated batch the state that it had before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from eventlens.operators.rolling import global_sequence
from eventlens.session import materialized
from eventlens.streaming.forms import read_slot, write_slot

_LOG = "epoch long, rows long"


def epoch_sink(path: str, route: Column | None = None, extra=None):
    """foreachBatch function that stores every row of a stream exactly once below ``path``.

    A batch is evaluated once: all its routes (the values of ``route``; rows of a NULL route leave the
    stream) go to one write, partitioned by epoch and route, and become visible together when the epoch is
    committed. A batch that failed between write and commit is invisible, and replaced when it runs
    again. ``extra`` (a function of the epoch) runs between the two, for tests. Read with ``committed``.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        last = last_epoch(spark, path)
        if last is not None and epoch_id <= last:
            return  # committed before the failure
        own = batch if route is None else batch.withColumn("route", route).where("route IS NOT NULL")
        w = own.write.mode("overwrite")
        (w if route is None else w.partitionBy("route")).parquet(f"{path.rstrip('/')}/data/epoch={epoch_id}")
        if extra:
            extra(epoch_id)
        write_slot(spark, f"{path.rstrip('/')}/log", epoch_id, [(epoch_id, 0)], _LOG)
    return write


def last_epoch(spark: SparkSession, path: str) -> int | None:
    """The last committed epoch of an ``epoch_sink``; None before the first."""
    return max((r.epoch for slot in (0, 1) if (t := read_slot(spark, f"{path.rstrip('/')}/log", slot, _LOG)) is not None for r in t.collect()), default=None)


def committed(spark: SparkSession, path: str, schema: str, route: str | None = None, routed: bool = False) -> DataFrame:
    """Rows (and ``epoch``; ``route``, if the sink has routes) of the committed epochs; epochs and routes are pruned as folders."""
    schema = f"{schema}, epoch long" + (", route string" if routed or route else "")
    last = last_epoch(spark, path)
    if last is None:
        return spark.createDataFrame([], schema)
    d = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/data").where(F.col("epoch") <= last)
    return d if route is None else d.where(F.col("route") == route)


def sequence_writer(arrival: str, sink, state_path: str, name: str = "seq"):
    """foreachBatch function that numbers the rows of a stream from 1 in order of arrival: by ``arrival`` in a
    micro-batch, and one micro-batch after the other.

    A batch is numbered as a table is: in range buckets with the counts before them. The number of rows so far is kept
    per epoch in two slots under ``state_path``; a repeated batch starts where it started before. ``sink`` gets
    (numbered rows, epoch); ``arrival`` orders a batch totally, so that it gets the same rows again.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        kept = read_slot(spark, state_path, epoch_id + 1, _LOG)
        row = kept.where(F.col("epoch") < epoch_id).first() if kept is not None else None
        before = row.rows if row else 0
        numbered = materialized(global_sequence(materialized(batch), arrival, name).withColumn(name, F.col(name) + F.lit(before)))
        sink(numbered, epoch_id)
        write_slot(spark, state_path, epoch_id, [(epoch_id, before + numbered.count())], _LOG)
    return write


def counted(df: DataFrame, name: str, ok: Column | None = None) -> DataFrame:
    """A stream whose micro-batches report the rows sent, and those of them that are not ``ok``, under ``name``."""
    good = ok if ok is not None else F.lit(True)
    return df.observe(name, F.count(F.lit(1)).alias("sent"), F.count_if(~F.coalesce(good, F.lit(False))).alias("errors"))


class StreamCounters(StreamingQueryListener):
    """Sums of the metrics that ``counted`` reports under ``name``, over all micro-batches and restarts.

    The sums are kept per batch in two slots under ``state_path``. A batch that ran again after a
    failure is counted once. Add with ``spark.streams.addListener``.
    """

    SCHEMA = "epoch long, sent long, errors long"

    def __init__(self, spark: SparkSession, name: str, state_path: str):
        self.spark, self.name, self.path = spark, name, state_path
        rows = [r for slot in (0, 1) if (t := read_slot(spark, state_path, slot, self.SCHEMA)) is not None for r in t.collect()]
        last = max(rows, key=lambda r: r.epoch, default=None)
        self.epoch, self.sent, self.errors = (last.epoch, last.sent, last.errors) if last else (-1, 0, 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        batch = event.progress.batchId
        if row is None or batch <= self.epoch:
            return
        self.epoch, self.sent, self.errors = batch, self.sent + row.sent, self.errors + row.errors
        write_slot(self.spark, self.path, batch, [(batch, self.sent, self.errors)], self.SCHEMA)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
