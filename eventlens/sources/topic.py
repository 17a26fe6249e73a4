"""Message-topic source and sink options (Kafka connector).

The connector jar is not part of a plain PySpark install; these helpers
only build the reader/writer, so they work wherever the jar is on the
classpath (``spark.jars.packages``) and fail at ``load()``/``start()``
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(servers: str, topic: str, starting_offsets: str = "latest", **extra) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    opts.update({k if k.startswith("kafka.") else f"kafka.{k}": str(v) for k, v in extra.items()})
    return opts


def read_topic(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
               streaming: bool = True, **extra) -> DataFrame:
    """String values of a topic as column ``value``."""
    r = spark.readStream if streaming else spark.read
    df = r.format("kafka").options(**topic_options(servers, topic, starting_offsets, **extra)).load()
    return df.select(F.col("value").cast("string").alias("value"))


def register_topic(spark: SparkSession, name: str, servers: str, topic: str, schema_ddl: str,
                   starting_offsets: str = "latest") -> DataFrame:
    """Topic with CSV values and a declared schema → temp view."""
    raw = read_topic(spark, servers, topic, starting_offsets)
    df = raw.select(F.from_csv("value", schema_ddl).alias("r")).select("r.*")
    df.createOrReplaceTempView(name)
    return df


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None, **extra):
    """String ``value`` column to a topic (batch write or streaming query)."""
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    opts.update({k if k.startswith("kafka.") else f"kafka.{k}": str(v) for k, v in extra.items()})
    out = df.select(F.col("value").cast("string").alias("value"))
    if out.isStreaming:
        w = out.writeStream.format("kafka").options(**opts)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    out.write.format("kafka").options(**opts).save()
    return None


def copy_lines_to_topic(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Bulk copy of a text file into a topic."""
    write_topic(spark.read.text(path), servers, topic)
