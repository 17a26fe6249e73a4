"""Streaming forms built from Spark's own stateful operators.

Every form takes a streaming DataFrame with a TIMESTAMP event-time column
and gives the same rows as the batch operator once the watermark has
passed (append mode).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.hashing import UV_BITMAP_BITS, UV_HASH_SEED, poly_hash, salt
from eventlens.functions.time import interval_ms, ms_to_spec, window_end_ms
from eventlens.operators.topn import top_n_per_group


def with_watermark(df: DataFrame, ts: str = "ts", delay="0 seconds") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, ms_to_spec(interval_ms(delay)))


def windowed_count_stream(df: DataFrame, keys, size, slide=None, ts: str = "ts", delay="0 seconds",
                          count_col: str = "cnt", allowed_lateness=0) -> DataFrame:
    """(keys, window_end, cnt) per window.

    Append mode emits each window once, when closed. With
    ``allowed_lateness`` the watermark trails by delay + lateness, and in
    ``update`` mode a window is emitted as soon as it changes and re-emitted
    when later rows (within the lateness) correct it — the last emitted
    count per window wins.
    """
    w = F.window(F.col(ts), ms_to_spec(interval_ms(size)),
                 ms_to_spec(interval_ms(slide)) if slide else None)
    trail = interval_ms(delay) + interval_ms(allowed_lateness)
    g = with_watermark(df, ts, f"{trail} milliseconds").groupBy(w.alias("window"), *keys).agg(
        F.count(F.lit(1)).alias(count_col))
    return g.select(*keys, window_end_ms("window").alias("window_end"), count_col)


def top_n_batch_writer(n: int, group_col: str, order_cols, sink):
    """foreachBatch function: closed-window counts of one micro-batch → top-n.

    In append mode every count of a window is emitted in the same
    micro-batch, so a per-batch ranking is the final ranking; no state is
    needed and nothing per window is collected.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        sink(top_n_per_group(batch, [group_col], order_cols, n), epoch_id)
    return write


def _slot(path: str, epoch: int) -> str:
    return f"{path.rstrip('/')}/slot={epoch % 2}"


def read_slot(spark, path: str, epoch: int, schema) -> DataFrame | None:
    """What an earlier batch wrote; None only if there is no such folder yet."""
    try:
        return spark.read.schema(schema).parquet(_slot(path, epoch))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_slot(spark, path: str, epoch: int, rows: list, schema: str) -> None:
    """A few rows of state after a batch; the other slot keeps what the batch itself began with."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(_slot(path, epoch))


def top_n_update_writer(n: int, keys, count_cols, order_cols, sink, state_path: str, open_for, end_col: str = "window_end"):
    """foreachBatch function for ``update`` mode: the last count per (window,
    keys) wins, and every window that a micro-batch changes is ranked anew over
    all its counts, changed in this batch or not.

    The counts of open windows are a table under ``state_path`` (the shared
    checkpoint folder), in two slots written in turn, so a repeated batch reads
    what it read before. ``open_for`` is window size + delay + allowed lateness:
    a window that ended so long before the newest one cannot change any more and
    leaves the table. ``sink`` gets whole rankings; the last one of a window counts.
    """
    open_ms, group = interval_ms(open_for), [end_col, *keys]

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*group, *count_cols)
        old = read_slot(spark, state_path, epoch_id + 1, rows.withColumn("epoch", F.lit(0).cast("long")).schema)
        both = rows.withColumn("_new", F.lit(1))
        if old is not None:
            both = both.unionByName(old.where(F.col("epoch") == epoch_id - 1).drop("epoch").withColumn("_new", F.lit(0)))
        last = F.max_by(F.struct(*count_cols), "_new").alias("_l")
        latest = both.groupBy(*group).agg(last, F.max("_new").alias("_new")).select(*group, "_l.*", "_new").persist()
        try:
            changed = latest.where("_new = 1").select(end_col).distinct()
            sink(top_n_per_group(latest.drop("_new").join(changed, end_col, "left_semi"), [end_col], order_cols, n), epoch_id)
            newest = latest.agg(F.max(end_col)).first()[0]
            still = latest.drop("_new").where(F.col(end_col) > F.lit(newest) - open_ms)
            still.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite").parquet(_slot(state_path, epoch_id))
        finally:
            latest.unpersist()
    return write


def unique_visitors_stream(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                           delay="0 seconds") -> DataFrame:
    """Exact visitors per window: deduplicate (window, user), then count."""
    w = with_watermark(df, ts, delay).withColumn("window", F.window(F.col(ts), ms_to_spec(interval_ms(size))))
    d = w.dropDuplicates(["window", user])
    return d.groupBy("window").agg(F.count(F.lit(1)).alias("uv")).select(
        window_end_ms("window").alias("window_end"), "uv")


def uv_approx_stream(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                     delay="0 seconds") -> DataFrame:
    g = with_watermark(df, ts, delay).groupBy(F.window(F.col(ts), ms_to_spec(interval_ms(size))).alias("window"))
    return g.agg(F.approx_count_distinct(user).alias("uv")).select(window_end_ms("window").alias("window_end"), "uv")


def late_router(ts_ms: str, size, delay, allowed_lateness, on_time_sink, late_sink, state_path: str):
    """foreachBatch router for too-late rows (side output).

    The watermark of a micro-batch is the max event time of all earlier
    batches minus ``delay`` (Spark's per-batch watermark). Rows whose window
    ended more than ``allowed_lateness`` before it go to ``late_sink``. The
    max is kept under ``state_path`` so a restarted query continues from it: a
    micro-batch writes one of two slots in turn, after its sinks, and reads the
    other one, so a repeated batch sees what it saw before. Only a missing slot
    means "no state yet"; any other read error fails the batch.
    """
    size_ms, delay_ms, late_ms = interval_ms(size), interval_ms(delay), interval_ms(allowed_lateness)

    def route(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        kept = read_slot(spark, state_path, epoch_id + 1, "epoch long, max_ts long")
        row = kept.where(F.col("epoch") < epoch_id).first() if kept is not None else None
        prev = row.max_ts if row else None
        end = (F.floor(F.col(ts_ms) / size_ms) + 1).cast("bigint") * size_ms
        late = F.lit(False) if prev is None else F.coalesce(end - 1 + F.lit(late_ms) <= F.lit(prev - delay_ms), F.lit(False))
        marked = batch.withColumn("window_end", end).withColumn("late", late).persist()
        try:
            on_time_sink(marked.where(~F.col("late")).drop("late"), epoch_id)
            late_sink(marked.where(F.col("late")).drop("late"), epoch_id)
            newest = marked.agg(F.max(ts_ms)).first()[0]
        finally:
            marked.unpersist()
        known = [int(x) for x in (prev, newest) if x is not None]
        write_slot(spark, state_path, epoch_id, [(epoch_id, max(known) if known else None)], "epoch long, max_ts long")
    return route


def _per_window(parts: DataFrame, size, value, name: str) -> DataFrame:
    """Second stage of a chained aggregation: partial results of a window, summed under the same watermark."""
    w = F.window(F.window_time("window"), ms_to_spec(interval_ms(size)))
    return parts.groupBy(w.alias("window")).agg(F.sum(value).cast("bigint").alias(name)).select(window_end_ms("window").alias("window_end"), name)


def salted_count_stream(df: DataFrame, salt_on: str, salts: int = 10, size="1 hour", ts: str = "ts", delay="0 seconds",
                        count_col: str = "cnt") -> DataFrame:
    """Rows per window in two chained stages: counts of (window, salt), which spread a window over tasks and
    state partitions, then their sum, once per closed window."""
    w = F.window(F.col(ts), ms_to_spec(interval_ms(size)))
    parts = with_watermark(df, ts, delay).groupBy(w.alias("window"), salt(F.col(salt_on), salts).alias("salt")).agg(F.count(F.lit(1)).alias("_n"))
    return _per_window(parts, size, F.col("_n"), count_col)


def uv_bitmap_stream(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts", delay="0 seconds", seed: int = UV_HASH_SEED,
                     bits: int = UV_BITMAP_BITS) -> DataFrame:
    """Visitors per window by a bitmap of hashed users, in two chained stages: state is one chunk of 32,768 bits per
    (window, bitmap bucket) that was touched, so that a hot window spreads; the chunks' counts are then summed."""
    w = F.window(F.col(ts), ms_to_spec(interval_ms(size)))
    hashed = with_watermark(df, ts, delay).select(F.col(ts), poly_hash(F.col(user), seed, bits).alias("h"))
    chunks = hashed.groupBy(w.alias("window"), F.bitmap_bucket_number("h").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits"))
    return _per_window(chunks, size, F.bitmap_count("bits"), "uv")
