"""Batch ≡ stream: each streaming form, fed the same rows as several files
(one per trigger) plus a far-future sentinel row, gives the batch answer."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eventlens.operators import changelog as C
from eventlens.operators import distinct as D
from eventlens.operators import fold as FO
from eventlens.operators import rolling as R
from eventlens.operators import rules as RU
from eventlens.operators import topn as N
from eventlens.operators import windows as W
from eventlens.plans import adapters as A
from eventlens.streaming import forms as SF
from eventlens.streaming import processors as PR
from eventlens.streaming.runner import run_stream

SF_DIR = "/root/testdata/sf0.001"
SENTINEL_ID = 10 ** 12


@pytest.fixture(scope="module")
def stream_dir(spark):
    ev = spark.read.parquet(f"{SF_DIR}/events.parquet")
    d = tempfile.mkdtemp(prefix="eventlens-stream-")
    n = ev.count()
    for i, (lo, hi) in enumerate([(0, n // 3), (n // 3, 2 * n // 3), (2 * n // 3, n)]):
        ev.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1) \
            .write.parquet(os.path.join(d, f"part{i}"))
    sentinel = spark.createDataFrame(
        [(SENTINEL_ID, "2030-01-01 00:00:00", -1, "view", 1.0, '{"k": 0}')],
        "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    sentinel.select(*ev.columns).coalesce(1).write.parquet(os.path.join(d, "part9"))
    return d


def events_stream(spark, d):
    schema = spark.read.parquet(f"{SF_DIR}/events.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true") \
        .parquet(d)


def batch_events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


def drain(df, name, mode="append"):
    q = run_stream(df, name, sink="memory", mode=mode, checkpoint=tempfile.mkdtemp(prefix="ckpt-"))
    q.awaitTermination()
    return df.sparkSession.table(name)


def same(a, b, cols):
    ra = sorted(tuple(r[c] for c in cols) for r in a.collect())
    rb = sorted(tuple(r[c] for c in cols) for r in b.collect())
    assert ra == rb and len(ra) > 0


def test_login_fail_timer_stream(spark, stream_dir):
    lg = A.logins(events_stream(spark, stream_dir)).withWatermark("ts", "0 seconds")
    out = drain(PR.apply(lg, "user_id", PR.LoginFailTimerProcessor(86400, 2), "EventTime"), "s_login")
    want = FO.login_fail_timer(A.logins(batch_events(spark)), 2, 86400)
    same(out, want, ["user_id", "first_fail_time", "last_fail_time", "warning_msg"])


def test_rising_alarm_stream(spark, stream_dir):
    rd = A.readings(events_stream(spark, stream_dir)).where(F.col("event_id") != SENTINEL_ID) \
        .unionByName(A.readings(events_stream(spark, stream_dir)).where(F.col("event_id") == SENTINEL_ID)
                     .withColumn("id", F.lit("sentinel"))).withWatermark("ts", "0 seconds")
    out = drain(PR.apply(rd, "id", PR.RisingAlarmProcessor(3600), "EventTime"), "s_rise")
    want = FO.rising_alarm(A.readings(batch_events(spark)), 3600)
    same(out.where("id != 'sentinel'"), want, ["id", "armed_ts", "fired_ts"])


def test_per_row_processors(spark, stream_dir):
    rd = A.readings(events_stream(spark, stream_dir)).where(F.col("event_id") != SENTINEL_ID)
    brd = A.readings(batch_events(spark))
    same(drain(PR.apply(rd, "id", PR.JumpAlarmProcessor(10.0)), "s_jump"),
         RU.jump_alarm(brd, "id", "event_id", "temperature", 10.0),
         ["id", "event_id", "last_temperature", "temperature"])
    same(drain(PR.apply(rd, "id", PR.RunningCountProcessor()), "s_count"),
         R.rolling_count(brd.select("id", "event_id"), "id", "event_id"), ["id", "event_id", "cnt"])
    same(drain(PR.apply(rd, "id", PR.CountWindowProcessor(10, 2)), "s_cw"),
         R.count_window(brd, "id", "event_id", "temperature", 10, 2), ["id", "n", "event_id", "cnt", "avg_temp"])
    same(drain(PR.apply(rd, "id", PR.ChangelogProcessor()), "s_chg"),
         C.changelog_count_avg(brd, "id", "event_id", "temperature"), ["id", "event_id", "op", "cnt", "avg_temp"])


def test_windowed_forms(spark, stream_dir):
    beh = A.behaviour(events_stream(spark, stream_dir)).where("behavior = 'pv'")
    bbeh = A.behaviour(batch_events(spark)).where("behavior = 'pv'")
    end = 1704067200000 + 40 * 86400000  # before the sentinel
    pv = drain(SF.windowed_count_stream(beh, [], "1 hour"), "s_pv").where(F.col("window_end") < end)
    same(pv, D.page_views(bbeh), ["window_end", "cnt"])
    uv = drain(SF.unique_visitors_stream(beh), "s_uv").where(F.col("window_end") < end)
    same(uv, D.unique_visitors(bbeh), ["window_end", "uv"])

    got = []

    def sink(df, epoch):
        got.extend(df.collect())

    counts = SF.windowed_count_stream(beh, ["item_id"], "1 hour", "5 minutes")
    q = run_stream(counts, "s_hot", foreach_batch=SF.top_n_batch_writer(
        5, "window_end", [F.col("cnt").desc(), F.col("item_id").asc()], sink),
        checkpoint=tempfile.mkdtemp(prefix="ckpt-"))
    q.awaitTermination()
    top = spark.createDataFrame([r for r in got if r["window_end"] < end])
    same(top, N.hot_items(A.behaviour(batch_events(spark))), ["item_id", "window_end", "cnt", "rn"])


def test_pattern_processors(spark, stream_dir):
    from eventlens.operators import patterns as PT
    lg = A.logins(events_stream(spark, stream_dir)).withWatermark("ts", "0 seconds")
    blg = A.logins(batch_events(spark))
    cols = ["user_id", "first_fail_time", "last_fail_time", "warning_msg"]
    same(drain(PR.apply(lg, "user_id", PR.SequenceMatchProcessor(["fail"] * 3, 86400), "EventTime"), "s_seq"),
         PT.login_fail_times(blg, 3, 86400), cols)
    same(drain(PR.apply(lg, "user_id", PR.FailPairProcessor(3600), "EventTime"), "s_pair"),
         RU.login_fail_pairs(blg, 3600), cols)


def test_keyed_state_processors(spark, stream_dir):
    ev = events_stream(spark, stream_dir).where(F.col("event_id") != SENTINEL_ID)
    bev = batch_events(spark)
    rd, brd = A.readings(ev), A.readings(bev)
    same(drain(PR.apply(rd, "id", PR.KeyedHistoryProcessor(5)), "s_hist"),
         R.keyed_history(brd.select("id", "event_id"), "id", "event_id", "event_id", 5),
         ["id", "event_id", "history"])
    upd = drain(PR.apply(ev, "user_id", PR.LatestValueMapProcessor()), "s_map")
    last = upd.groupBy("user_id", "event_type").agg(F.max_by("value", "event_id").alias("value"),
                                                    F.max("event_id").alias("event_id"))
    same(last, R.latest_value_map(bev, "user_id", "event_type", "value", "event_id"),
         ["user_id", "event_type", "value", "event_id"])
    glob = drain(PR.apply(rd.withColumn("id", F.lit("all")), "id", PR.RunningCountProcessor()), "s_glob")
    same(glob.select("event_id", F.col("cnt").alias("seq")),
         R.global_sequence(bev.select("event_id"), "event_id"), ["event_id", "seq"])
    from eventlens.functions.hashing import poly_hash
    from eventlens.functions.time import window_end_ms
    pv = A.behaviour(ev).where("behavior = 'pv'").select(
        window_end_ms(F.window("ts", "1 hour")).alias("window_end"), poly_hash(F.col("user_id")).alias("h"),
        "event_id", "ts")
    pv = SF.with_watermark(pv)
    same(drain(PR.apply(pv, "window_end", PR.UvRunningProcessor(), time_mode="EventTime"), "s_uvrun").where("event_id < 1000000000000"),
         D.uv_running(A.behaviour(bev).where("behavior = 'pv'")), ["window_end", "event_id", "uv"])


def test_update_mode_with_lateness(spark, stream_dir):
    beh = A.behaviour(events_stream(spark, stream_dir)).where("behavior = 'pv'")
    out = drain(SF.windowed_count_stream(beh, [], "1 hour", delay="10 minutes", allowed_lateness="10 minutes"),
                "s_upd", mode="update")
    final = out.groupBy("window_end").agg(F.max("cnt").alias("cnt")).where(F.col("window_end") < 1704067200000 + 40 * 86400000)
    same(final, D.page_views(A.behaviour(batch_events(spark)).where("behavior = 'pv'")), ["window_end", "cnt"])


def test_update_mode_top_n_ranks_corrected_windows(spark, tmp_path):
    """Out-of-order files: a later file changes one item of a window ranked before."""
    schema = "item_id string, at long"
    for i, part in enumerate([[("a", 10), ("a", 20), ("b", 30)], [("b", 40), ("b", 50), ("c", 3700)], [("c", 60), (None, 61), ("c", 9000)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/part{i}"))
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    counts = SF.windowed_count_stream(src.withColumn("ts", F.timestamp_seconds("at")), ["item_id"], "1 hour", allowed_lateness="2 hours")
    got = {}

    def sink(df, epoch):
        new = {}
        for r in df.collect():
            new.setdefault(r.window_end // 3_600_000, {})[r.rn] = (r.item_id, r.cnt)
        got.update(new)

    writer = SF.top_n_update_writer(2, ["item_id"], ["cnt"], [F.col("cnt").desc(), F.col("item_id").asc()], sink,
                                    str(tmp_path / "state"), "3 hours")
    run_stream(counts, "s_top_upd", mode="update", foreach_batch=writer, checkpoint=str(tmp_path / "ckpt")).awaitTermination()
    assert got == {1: {1: ("b", 3), 2: ("a", 2)}, 2: {1: ("c", 1)}, 3: {1: ("c", 1)}}
    kept = spark.read.parquet(str(tmp_path / "state")).where("epoch = 2")
    assert sorted((r.window_end // 3_600_000, r.item_id or "", r.cnt) for r in kept.collect()) == [
        (1, "", 1), (1, "a", 2), (1, "b", 3), (1, "c", 1), (2, "c", 1), (3, "c", 1)]


def test_map_state_removes_and_clears(spark, tmp_path):
    schema = "user_id long, event_type string, value double, event_id long"
    rows = [(1, "x", 1.0, 1), (1, "y", 2.0, 2), (1, "x", None, 3), (2, "x", 5.0, 4), (2, None, 0.0, 5), (2, "z", 6.0, 6), (1, "x", 7.0, 7), (1, "y", None, 8)]
    src = spark.createDataFrame(rows, schema)
    src.coalesce(1).write.parquet(str(tmp_path / "in"))
    st = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    upd = drain(PR.apply(st, "user_id", PR.LatestValueMapProcessor()), "s_map_rm")
    assert sorted(r.event_id for r in upd.collect()) == [1, 2, 4, 6, 7]
    want = R.latest_value_map(src, "user_id", "event_type", "value", "event_id", removes=True)
    assert sorted(tuple(r) for r in want.collect()) == [(1, "x", 7.0, 7), (2, "z", 6.0, 6)]


def test_uv_approx_stream(spark, stream_dir):
    beh = A.behaviour(events_stream(spark, stream_dir)).where("behavior = 'pv'")
    end = 1704067200000 + 40 * 86400000
    got = {r.window_end: r.uv for r in drain(SF.uv_approx_stream(beh), "s_hll").where(F.col("window_end") < end).collect()}
    exact = {r.window_end: r.uv for r in D.unique_visitors(A.behaviour(batch_events(spark)).where("behavior = 'pv'")).collect()}
    assert set(got) == set(exact)
    assert all(abs(got[w] - exact[w]) <= max(1, 0.05 * exact[w]) for w in exact)
