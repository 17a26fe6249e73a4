"""Streaming sinks under failures: epochs and routes, sequences, counters; file tables with bad records."""

import os

import pytest
from pyspark.sql import functions as F

from eventlens.sources import files as FI
from eventlens.streaming import forms, sinks
from eventlens.streaming.runner import run_stream


@pytest.fixture()
def source(spark, tmp_path):
    """Three files of 40 numbered rows, one micro-batch each; they have different times of change."""
    d = str(tmp_path / "in")
    for k in range(3):
        spark.range(k * 40, k * 40 + 40).select("id", (F.col("id") % 7).alias("user_id")).coalesce(1).write.mode("append").parquet(d)
        for f in os.listdir(d):
            if f.endswith(".parquet") and os.path.getmtime(f"{d}/{f}") > 1_000_000:
                os.utime(f"{d}/{f}", (1000 + k, 1000 + k))
    return spark.readStream.schema("id long, user_id long").option("maxFilesPerTrigger", 1).parquet(d)


def run(df, path, function):
    return run_stream(df, "q" + os.path.basename(path), checkpoint=f"{path}/checkpoint", foreach_batch=function)


class Crash(Exception):
    pass


def fail_at(epoch):
    def hit(e):
        if e == epoch:
            raise Crash(f"lost in epoch {e}")
    return hit


def test_routes_of_an_epoch_are_committed_together_and_once(spark, source, tmp_path):
    out, route = str(tmp_path / "out"), F.when(F.col("id") % 3 == 0, "fizz").when(F.col("id") % 5 > 0, "rest")
    schema = "id long, user_id long"
    q = run(source, str(tmp_path), sinks.epoch_sink(out, route, fail_at(1)))
    with pytest.raises(Exception, match="lost in epoch 1"):
        q.awaitTermination()
    # Epoch 1 was written, not committed: its rows are on disk, and not in the table.
    assert os.path.isdir(f"{out}/data/epoch=1") and sinks.last_epoch(spark, out) == 0
    assert sinks.committed(spark, out, schema, routed=True).where("epoch > 0").count() == 0
    run(source, str(tmp_path), sinks.epoch_sink(out, route)).awaitTermination()
    got = {(r.id, r.route) for r in sinks.committed(spark, out, schema, routed=True).collect()}
    want = {(i, "fizz" if i % 3 == 0 else "rest") for i in range(120) if i % 3 == 0 or i % 5 > 0}
    assert got == want and sinks.committed(spark, out, schema, routed=True).count() == len(want)
    assert {r.id for r in sinks.committed(spark, out, schema, route="fizz").collect()} == {i for i in range(120) if i % 3 == 0}


def test_a_batch_that_was_committed_is_not_written_again(spark, tmp_path):
    out = str(tmp_path / "out")
    write = sinks.epoch_sink(out)
    write(spark.range(5), 0)
    write(spark.range(9), 0)
    assert sinks.committed(spark, out, "id long").count() == 5
    assert sinks.committed(spark, str(tmp_path / "nothing"), "id long").collect() == []


def test_sequence_over_micro_batches_and_a_crash(spark, source, tmp_path, monkeypatch):
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "9")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    numbered = lambda hit=None: sinks.sequence_writer("id", sinks.epoch_sink(out, extra=hit), state)
    with pytest.raises(Exception, match="lost in epoch 2"):
        run(source, str(tmp_path), numbered(fail_at(2))).awaitTermination()
    run(source, str(tmp_path), numbered()).awaitTermination()
    rows = sinks.committed(spark, out, "id long, user_id long, seq long").orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(1, 121))
    assert all([r.id for r in rows if r.epoch == e] == sorted(r.id for r in rows if r.epoch == e) for e in range(3))


def test_counters_survive_a_restart_and_count_a_batch_once(spark, source, tmp_path):
    def one_run(hit):
        counters = sinks.StreamCounters(spark, "sent", str(tmp_path / "state"))
        spark.streams.addListener(counters)
        try:
            q = run(sinks.counted(source, "sent", F.col("user_id") != 3), str(tmp_path), sinks.epoch_sink(str(tmp_path / "out"), extra=hit))
            try:
                q.awaitTermination()
            except Exception as e:  # noqa: BLE001
                assert "lost" in str(e)
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        finally:
            spark.streams.removeListener(counters)
        return counters

    first = one_run(fail_at(1))
    assert first.epoch < 2
    second = one_run(None)
    assert (second.sent, second.errors) == (120, sum(i % 7 == 3 for i in range(120)))
    kept = sinks.StreamCounters(spark, "sent", str(tmp_path / "state"))
    assert (kept.epoch, kept.sent, kept.errors) == (2, 120, second.errors)


def test_chained_stages_agree_with_the_batch_form(spark, tmp_path):
    from eventlens.operators import distinct as D
    d = str(tmp_path / "in")
    rows = spark.range(3000).select((F.col("id") % 2 + F.col("id") % 37).alias("user_id"), "id", F.timestamp_seconds(F.col("id") * 11).alias("ts"))
    rows.repartition(2).write.parquet(d)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(d)
    last = 2999 * 11 * 1000
    for name, out, batch in (("cnt", forms.salted_count_stream(stream(), "id", 4), D.page_views(rows)), ("uv", forms.uv_bitmap_stream(stream()), D.uv_bitmap(rows))):
        path = str(tmp_path / name)
        run(out, path, sinks.epoch_sink(f"{path}/out")).awaitTermination()
        got = {(r.window_end, r[name]) for r in sinks.committed(spark, f"{path}/out", f"window_end long, {name} long").collect()}
        assert got == {(r.window_end, r[name]) for r in batch.collect() if r.window_end <= last} and len(got) == 9


def test_bad_records_of_a_file_table(spark, tmp_path):
    lines = ['id,n,note', '1,2.5,plain', '2,,"a, ""b"""', '3,x,y', '4', '5,1,2,3', '', '6,-1e3,é']
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("\n".join(lines) + "\n")
    read = lambda streaming=False: FI.read_table(spark, str(tmp_path / "t"), "id bigint, n double, note string", streaming, header=lines[0])
    assert sorted(tuple(r) for r in FI.good_records(read()).collect() if r.id) == [(1, 2.5, "plain"), (2, None, 'a, "b"'), (6, -1000.0, "é")]
    assert {r.line for r in FI.bad_records(read()).select("line").collect()} - {""} == {"3,x,y", "4", "5,1,2,3"}
    out = str(tmp_path / "out")
    run(FI.bad_records(read(True)).select("line"), str(tmp_path / "s"), sinks.epoch_sink(out)).awaitTermination()
    assert {r.line for r in sinks.committed(spark, out, "line string").collect()} - {""} == {"3,x,y", "4", "5,1,2,3"}


def test_console_shows_labelled_rows(spark, tmp_path, capsys):
    from eventlens.sinks import to_console
    to_console(spark.range(2), "numbers")
    shown = capsys.readouterr().out
    assert "numbers> 0" in shown and "numbers> 1" in shown
    d = str(tmp_path / "in")
    spark.range(3).write.parquet(d)
    q = to_console(spark.readStream.schema("id long").parquet(d), "numbers")
    try:
        q.processAllAvailable()
        assert q.recentProgress[-1]["sink"]["description"].startswith("org.apache.spark.sql") and q.exception() is None
    finally:
        q.stop()
