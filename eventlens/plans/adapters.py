"""Adapters from the driver's tables to the record types of the analyses.

All adapters are lazy projections; Catalyst prunes unread columns and
pushes filters through them into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.time import epoch_s
from eventlens.operators.rolling import global_sequence

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: number of partitions that ``documents`` deals its rows to before they are tokenized.
INPUT_PARTITIONS = "spark.eventlens.inputPartitions"


def documents(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The documents table. Tables of large files are read by many tasks as they are; for a table of one or few
    row groups, ``partitions`` (or the setting ``spark.eventlens.inputPartitions``) deals the rows to that many
    tasks, at the price of a shuffle of the texts."""
    n = partitions or int(spark.conf.get(INPUT_PARTITIONS, "0"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.repartition(n) if n else docs


def behaviour(events: DataFrame, pv_only: bool = False) -> DataFrame:
    """events → user behaviour: item = props.k, 'view' → 'pv', time in seconds.

    ``pv_only`` keeps only page views with a predicate on the raw column
    (``event_type IN ('view', 'pv')`` — exactly the rows mapped to 'pv'),
    which the parquet scan can evaluate, unlike a filter on the mapped value.
    """
    if pv_only:
        events = events.where(F.col("event_type").isin("view", "pv"))
    item = F.get_json_object("props", "$.k").cast("bigint")
    ts_s = epoch_s("ts")
    return events.select(
        "event_id",
        F.col("user_id"),
        item.alias("item_id"),
        F.pmod(item, F.lit(10)).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        ts_s.alias("timestamp"),
        F.timestamp_seconds(ts_s).alias("ts"),
    )


def readings(events: DataFrame) -> DataFrame:
    """events → sensor readings: 12 sensors, temperature = value, arrival = event_id.

    ``temp_cents`` keeps the two-decimal measure as an exact integer so
    sums and averages are exact (no float re-association differences).
    """
    ts_s = epoch_s("ts")
    return events.select(
        "event_id",
        F.concat(F.lit("sensor_"), F.pmod(F.col("user_id"), F.lit(12)).cast("string")).alias("id"),
        ts_s.alias("timestamp"),
        F.col("value").alias("temperature"),
        F.round(F.col("value") * 100).cast("bigint").alias("temp_cents"),
        F.timestamp_seconds(ts_s).alias("ts"),
    )


def logins(events: DataFrame) -> DataFrame:
    """events → login events: 'error' is a failed login, anything else a success."""
    ts_s = epoch_s("ts")
    return events.select(
        "event_id",
        "user_id",
        ip_of(F.col("user_id")).alias("ip"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("login_state"),
        ts_s.alias("timestamp"),
        F.timestamp_seconds(ts_s).alias("ts"),
    )


def ip_of(user_id) -> F.Column:
    return F.concat_ws(".", F.lit("10"),
                       F.pmod(F.floor(user_id / 65536), F.lit(256)).cast("string"),
                       F.pmod(F.floor(user_id / 256), F.lit(256)).cast("string"),
                       F.pmod(user_id, F.lit(256)).cast("string"))


# Every 11th page is rendered as a static asset of one of these kinds.
ASSETS = ("css", "js", "png", "ico")


def visited_pages(events: DataFrame, pages: DataFrame) -> DataFrame:
    """events ⋈ pages: event columns and ``url``. The page is the one numbered
    event_id mod #pages, pages numbered from 0 by page_id, so any ids do. The
    URL of the pages numbered 0, 11, 22, … ends as a static asset. The page
    count is a scalar subquery; the equi-join broadcasts only a pages side under
    the threshold."""
    n_pages = pages.select(F.nullif(F.count(F.lit(1)), F.lit(0))).scalar()
    no = global_sequence(pages.select("page_id", "url"), "page_id").select((F.col("seq") - 1).alias("_no"), "url")
    kind = F.element_at(F.array(*map(F.lit, ASSETS)), (F.pmod(F.floor(F.col("_no") / 11), F.lit(len(ASSETS))) + 1).cast("int"))
    url = F.when(F.col("_no") % 11 == 0, F.concat("url", F.lit("."), kind)).otherwise(F.col("url"))
    ev = events.withColumn("_no", F.pmod(F.col("event_id"), n_pages))
    return ev.join(no.select("_no", url.alias("url")), "_no").drop("_no")


def method_of(event_type) -> F.Column:
    return F.when(event_type.isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET"))


def access_log_lines(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Visited pages rendered as access-log lines.

    Line: ``ip - - dd/MM/yyyy:HH:mm:ss +0000 METHOD url``; purchases and
    signups are POSTs.
    """
    j = visited_pages(events.select("event_id", "user_id", "event_type", "ts"), pages)
    method = method_of(F.col("event_type"))
    t = F.date_format(F.col("ts").cast("timestamp"), "dd/MM/yyyy:HH:mm:ss")
    line = F.concat_ws(" ", ip_of(F.col("user_id")), F.lit("-"), F.lit("-"), t, F.lit("+0000"),
                       method, F.col("url"))
    return j.select("event_id", line.alias("value"))


def broken_lines(records: DataFrame, fields: list, every: int = 17) -> DataFrame:
    """Records as comma-separated lines (``event_id``, ``value``); every 17th event's
    line lacks its first field, every other 19th has a word for its last."""
    e = F.col("event_id")
    whole = F.array(*[F.col(c).cast("string") for c in fields])
    cut = lambda x: F.when(e % every == 0, F.slice(x, 2, len(fields) - 1)).when(
        e % (every + 2) == 0, F.array_append(F.slice(x, 1, len(fields) - 1), "soon")).otherwise(x)
    return records.select("event_id", F.array_join(F.get(F.transform(F.array(whole), cut), F.lit(0)), ",").alias("value"))


def arrivals(events: DataFrame, spread_s: int = 5400) -> DataFrame:
    """A synthetic out-of-order arrival order for lateness models (the tables hold none): arrival = ts + (id·7919 mod spread) s."""
    ts_s = epoch_s("ts")
    return events.select(
        "event_id", "user_id", "event_type",
        ts_s.alias("timestamp"),
        F.timestamp_seconds(ts_s).alias("ts"),
        (ts_s + F.pmod(F.col("event_id") * 7919, F.lit(spread_s))).alias("arrival"),
    )
