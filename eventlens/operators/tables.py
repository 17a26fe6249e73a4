"""Table surface: temp views, SQL and grouped statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.rolling import avg_half_up, beyond, exact


def as_event_table(df: DataFrame, name: str, cols, time_col: str | None = None,
                   delay: str | None = None) -> DataFrame:
    """Register ``cols`` (plus an event-time attribute with a watermark on
    streams) as a temp view, like a stream → table conversion."""
    t = df.select(*cols)
    if time_col and delay and t.isStreaming:
        t = t.withWatermark(time_col, delay)
    t.createOrReplaceTempView(name)
    return t


def sensor_stats(readings: DataFrame) -> DataFrame:
    """groupBy(id): cnt = count(id), avg_temp = exact average of ``temperature``, any
    numeric column (half-up, 4 places; NULLs are left out)."""
    v, w = exact(F.col("temperature")), beyond(F.col("temperature"))
    g = readings.groupBy("id").agg(F.count("id").alias("cnt"), F.sum(v).alias("_s"), (F.count(v) + F.count(w)).alias("_k"), F.sum(w).alias("_r"))
    return g.select("id", "cnt", avg_half_up(F.col("_s"), F.col("_k"), F.col("_r")).alias("avg_temp"))


def sensor_stats_sql(spark: SparkSession, readings: DataFrame, view: str = "sensor") -> DataFrame:
    readings.select("id", "temperature").createOrReplaceTempView(view)
    return spark.sql(f"""
        WITH vals AS (
          SELECT id, v, CASE WHEN v IS NULL AND NOT isnan(t) AND abs(t) < CAST('Infinity' AS DOUBLE) THEN t END AS w
          FROM (SELECT id, try_cast(temperature AS DECIMAL(38, 8)) AS v, CAST(temperature AS DOUBLE) AS t FROM {view})),
        sums AS (
          SELECT id, count(id) AS cnt, sum(v) AS s, sum(w) AS r, CAST(nullif(count(v) + count(w), 0) AS DECIMAL(19, 0)) AS n
          FROM vals GROUP BY id)
        SELECT id, cnt, CASE WHEN r IS NOT NULL THEN (coalesce(CAST(s AS DOUBLE), 0D) + r) / n
          WHEN abs(CAST(s AS DOUBLE)) >= n * 1e13D THEN CAST(s AS DOUBLE) / n
          ELSE (CAST((s - pmod(s, n)) div n AS DOUBLE) * 10000 + (pmod(s, n) * 20000 + n) div (n * 2)) / 10000 END AS avg_temp
        FROM sums
    """)
