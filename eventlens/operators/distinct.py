"""Page views and unique-visitor counting per window: exact, bitmap, sketch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.hashing import UV_BITMAP_BITS, UV_HASH_SEED, poly_hash, salt
from eventlens.functions.time import interval_ms, ms_to_spec, window_end_ms
from eventlens.operators.prefix import Prefix, running_aggregates


def _win(time_col: str, size):
    return F.window(F.col(time_col), ms_to_spec(interval_ms(size))).alias("window")


def page_views(df: DataFrame, time_col: str = "ts", size="1 hour") -> DataFrame:
    """Rows per tumbling window (one global key): window_end, cnt."""
    g = df.groupBy(_win(time_col, size)).agg(F.count(F.lit(1)).alias("cnt"))
    return g.select(window_end_ms("window").alias("window_end"), "cnt")


def page_views_salted(df: DataFrame, salt_col: str = "event_id", n_salts: int = 10,
                      time_col: str = "ts", size="1 hour") -> DataFrame:
    """Two-phase count for a hot single key: count per (window, salt), then sum.

    The salt is a hash of ``salt_col`` (deterministic on task retry). With a
    combinable count Spark's map-side partial aggregation already bounds the
    shuffle; the explicit salt keeps the second phase spread over
    ``n_salts`` reducers for aggregates that cannot combine map-side.
    """
    first = (df.groupBy(_win(time_col, size), salt(F.col(salt_col), n_salts).alias("_salt"))
               .agg(F.count(F.lit(1)).alias("_n")))
    second = first.groupBy("window").agg(F.sum("_n").cast("bigint").alias("cnt"))
    return second.select(window_end_ms("window").alias("window_end"), "cnt")


def unique_visitors(df: DataFrame, user_col: str = "user_id", time_col: str = "ts", size="1 hour") -> DataFrame:
    """Exact distinct visitors per tumbling window: window_end, uv.

    Spark plans the distinct as a two-level aggregate (window, user) then
    window, so no window's visitor set is held in one place.
    """
    g = df.groupBy(_win(time_col, size)).agg(F.count_distinct(F.col(user_col)).alias("uv"))
    return g.select(window_end_ms("window").alias("window_end"), "uv")


def uv_hash(df: DataFrame, user_col: str = "user_id", seed: int = UV_HASH_SEED,
            bits: int = UV_BITMAP_BITS) -> DataFrame:
    return df.withColumn("h", poly_hash(F.col(user_col), seed, bits))


def uv_bitmap(df: DataFrame, user_col: str = "user_id", time_col: str = "ts", size="1 hour",
              seed: int = UV_HASH_SEED, bits: int = UV_BITMAP_BITS) -> DataFrame:
    """Visitors per window counted as set bits of a hashed bitmap.

    Bit = polynomial hash of the visitor id mod 2^bits (collisions
    undercount, as a single-hash bitmap does). The bitmap is built with
    Spark's bitmap aggregates: one 32,768-bit chunk per (window, bucket),
    only touched chunks exist, and chunks merge map-side.
    """
    h = poly_hash(F.col(user_col), seed, bits)
    chunks = (df.select(_win(time_col, size), h.alias("h"))
                .groupBy("window", F.bitmap_bucket_number("h").alias("_bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("_bm")))
    g = chunks.groupBy("window").agg(F.sum(F.bitmap_count("_bm")).cast("bigint").alias("uv"))
    return g.select(window_end_ms("window").alias("window_end"), "uv")


def uv_running(df: DataFrame, user_col: str = "user_id", arrival_col: str = "event_id",
               time_col: str = "ts", size="1 hour", seed: int = UV_HASH_SEED,
               bits: int = UV_BITMAP_BITS) -> DataFrame:
    """One row each time a new bit is set in a window's bitmap.

    Columns: window_end, event_id (the arrival that set the bit), uv (bits
    set so far). First arrival per (window, bit) is a combinable min; the
    running number per window is a two-phase prefix count, so a busy
    window is not numbered in a single task.
    """
    h = poly_hash(F.col(user_col), seed, bits)
    firsts = (df.select(window_end_ms(F.window(F.col(time_col), ms_to_spec(interval_ms(size))))
                        .alias("window_end"), h.alias("h"), F.col(arrival_col))
                .groupBy("window_end", "h").agg(F.min(arrival_col).alias(arrival_col)))
    numbered = running_aggregates(firsts, ["window_end"], [arrival_col, "h"], {"uv": Prefix("count")})
    return numbered.select("window_end", arrival_col, "uv")


def uv_approx(df: DataFrame, user_col: str = "user_id", time_col: str = "ts", size="1 hour",
              rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ distinct visitors per window (bounded state, streaming-safe)."""
    g = df.groupBy(_win(time_col, size)).agg(F.approx_count_distinct(F.col(user_col), rsd).alias("uv"))
    return g.select(window_end_ms("window").alias("window_end"), "uv")
