"""Reproducible random-walk sensor readings.

Each of ``n_sensors`` sensors starts at 60 + 20·N(0,1) and moves by N(0,1)
per step. Generated with ``spark.range`` + seeded ``randn`` and a per-sensor
running sum, so it is deterministic and parallel. Also registered as a
Python data source (``format('sensor_walk')``) for the reader API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.prefix import Prefix, running_aggregates

# Fixed values of the walk: start mean 60, start spread 20, unit steps.
START_MEAN = 60.0
START_SPREAD = 20.0


def sensor_walk(spark: SparkSession, n_sensors: int = 10, n_steps: int = 100, seed: int = 7,
                start_ms: int = 1_547_718_199_000, step_ms: int = 100) -> DataFrame:
    """Columns: id, timestamp (ms), temperature, step."""
    sensors = spark.range(n_sensors).select(
        F.col("id").alias("s"), (F.lit(START_MEAN) + F.lit(START_SPREAD) * F.randn(seed)).alias("t0"))
    pairs = spark.range(n_sensors * n_steps).select(
        (F.col("id") % n_sensors).alias("s"), (F.col("id") / n_sensors).cast("bigint").alias("step"),
        F.randn(seed + 1).alias("d"))
    steps = pairs.join(sensors, "s").withColumn("_d", F.when(F.col("step") > 0, F.col("d")).otherwise(0.0))
    # running sum of steps per sensor: two-phase prefix (no per-sensor partition)
    walk = running_aggregates(steps, ["s"], ["step"], {"_walk": Prefix("sum", "_d")}).select(
        F.concat(F.lit("sensor_"), (F.col("s") + 1).cast("string")).alias("id"),
        (F.lit(start_ms) + F.col("step") * F.lit(step_ms)).alias("timestamp"),
        (F.col("t0") + F.col("_walk")).alias("temperature"),
        "step")
    return walk


try:  # Python data source API (Spark 4): spark.read.format("sensor_walk")
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class _Part(InputPartition):
        def __init__(self, sensor: int):
            self.sensor = sensor

    class SensorWalkReader(DataSourceReader):
        def __init__(self, options):
            self.n = int(options.get("sensors", 10))
            self.steps = int(options.get("steps", 100))
            self.seed = int(options.get("seed", 7))

        def partitions(self):
            return [_Part(i) for i in range(self.n)]  # one partition per sensor

        def read(self, partition):
            import random
            rng = random.Random(self.seed * 1_000_003 + partition.sensor)
            t = START_MEAN + START_SPREAD * rng.gauss(0, 1)
            for step in range(self.steps):
                if step:
                    t += rng.gauss(0, 1)
                yield (f"sensor_{partition.sensor + 1}", 1_547_718_199_000 + step * 100, t)

    class SensorWalkDataSource(DataSource):
        @classmethod
        def name(cls):
            return "sensor_walk"

        def schema(self):
            return "id string, timestamp bigint, temperature double"

        def reader(self, schema):
            return SensorWalkReader(self.options)

    def register_sensor_walk(spark: SparkSession) -> None:
        spark.dataSource.register(SensorWalkDataSource)
except ImportError:  # pragma: no cover
    def register_sensor_walk(spark: SparkSession) -> None:
        raise RuntimeError("Python data sources need PySpark 4")
