"""Session creation and shared settings (one session serves batch and streaming)."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the library relies on.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalescing sizes post-shuffle partitions by the bytes *entering* the
    # next stage; sliding windows and count windows multiply rows right after
    # a small shuffle, so keep the floor low and let parallelism win.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "eventlens", extra: dict | None = None) -> SparkSession:
    """Return a session with UTC time, AQE and the RocksDB state store.

    On a cluster, call with ``master=None`` so the launcher's settings win.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("EVENTLENS_DRIVER_MEM", "8g"))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_sql_defaults(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators rely on (any session)."""
    for k, v in _DEFAULTS.items():
        if k.startswith("spark.sql.streaming.stateStore"):
            continue  # fixed at first use of the state store
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and streaming checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    and the whole session is one process (``local[n]``, as in tests), a scratch
    folder is made; on any cluster an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="eventlens-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def run_folder(spark: SparkSession) -> str:
    """Folder of the application's intermediate tables in the shared folder; removed when the application ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/eventlens-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def materialized(df: DataFrame) -> DataFrame:
    """``df`` as a table in the run folder: computed once for all that reads it, compressed, and safe from lost executors."""
    path = f"{run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
