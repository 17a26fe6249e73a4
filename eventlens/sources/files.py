"""Rows, text lines and CSV tables as (batch or streaming) DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_rows(spark: SparkSession, rows, schema: str, arrival: str | None = None) -> DataFrame:
    """Bounded in-memory input. ``arrival`` adds the 0-based row position as a
    column so that order-dependent operators see the input order."""
    rows = list(rows)
    if arrival:
        return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{schema}, {arrival} BIGINT")
    return spark.createDataFrame(rows, schema)


def read_lines(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "text",
               max_files_per_trigger: int | None = None, host: str | None = None,
               port: int | None = None) -> DataFrame:
    """One row per line (column ``value``).

    Batch: ``spark.read.text``. Streaming: a directory of text files
    (replayable, exactly-once with a checkpoint) or, with ``fmt='socket'``,
    a socket (not replayable — no recovery guarantees).
    """
    if not streaming:
        return spark.read.text(path)
    r = spark.readStream
    if fmt == "socket":
        return r.format("socket").option("host", host or "localhost").option("port", int(port or 7777)).load()
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.text(path)


def register_csv(spark: SparkSession, name: str, path: str, schema: str, streaming: bool = False,
                 header: bool = False) -> DataFrame:
    """File + CSV format + declared schema → temp view ``name``."""
    r = spark.readStream if streaming else spark.read
    df = r.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE").csv(path)
    df.createOrReplaceTempView(name)
    return df


#: Column that takes the whole line of a record that does not fit its schema.
CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, path: str, schema: str, streaming: bool = False, header: str | None = None, **options) -> DataFrame:
    """Lines of CSV files as a table of a declared schema, batch or streaming, with ``_corrupt_record``: NULL where a
    line fits the schema, else the line itself (too few or many fields, a field of another type). Quoted fields may
    hold separators and doubled quotes, not line ends. ``header`` is a line to skip wherever it stands.

    Spark's file reader judges a line by the columns that a query happens to read; here it is parsed once, whole:
    the record comes out of a generator, so that neither filters nor unread columns change it.
    """
    lines = read_lines(spark, path, streaming)
    if header is not None:
        lines = lines.where(F.col("value") != header)
    parse = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"', **options}
    return lines.select(F.explode(F.array(F.from_csv("value", f"{schema}, {CORRUPT} string", parse))).alias("r")).select("r.*")


def good_records(table: DataFrame) -> DataFrame:
    return table.where(f"{CORRUPT} IS NULL").drop(CORRUPT)


def bad_records(table: DataFrame) -> DataFrame:
    return table.where(f"{CORRUPT} IS NOT NULL").withColumnRenamed(CORRUPT, "line")
