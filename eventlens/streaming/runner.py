"""Starting streaming queries with checkpoints, triggers and output modes."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventlens.session import checkpoint_dir


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of a named query under the shared checkpoint dir."""
    return os.path.join(checkpoint_dir(spark), "streams", name)


def run_stream(df: DataFrame, name: str, sink: str = "memory", mode: str = "append",
               checkpoint: str | None = None, trigger: str | dict | None = "availableNow",
               path: str | None = None, foreach_batch=None, options: dict | None = None) -> StreamingQuery:
    """Start ``df`` as a streaming query.

    * ``mode``: append (final rows only), update (changed rows per trigger,
      re-emitting windows corrected within the allowed lateness) or complete.
    * ``trigger``: ``"availableNow"``, ``"once"``, a processing-time interval
      such as ``"100 milliseconds"``, or a dict passed to ``trigger``.
    * ``checkpoint``: offsets + state; restarting with the same folder
      resumes exactly once for replayable sources and idempotent sinks.
    """
    spark = df.sparkSession
    w = df.writeStream.queryName(name).outputMode(mode)
    w = w.option("checkpointLocation", checkpoint or stream_checkpoint(spark, name))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif sink in ("parquet", "json", "csv", "text"):
        w = w.format(sink).option("path", path)
    else:
        w = w.format(sink)
    if isinstance(trigger, dict):
        w = w.trigger(**trigger)
    elif trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger == "once":
        w = w.trigger(once=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def restart_policy(max_restarts: int = 3, delay_s: float = 10.0):
    """Run ``start()`` (a callable returning a StreamingQuery) and restart it
    from its checkpoint up to ``max_restarts`` times on failure."""
    import time

    def run(start):
        attempts = 0
        while True:
            q = start()
            try:
                q.awaitTermination()
                return q
            except Exception:  # noqa: BLE001
                attempts += 1
                if attempts > max_restarts:
                    raise
                time.sleep(delay_s)
    return run
