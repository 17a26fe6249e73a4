"""Sources, partitioning, processing time, restarts and the late-row router."""

import os
import tempfile

from pyspark.sql import functions as F

from eventlens import schemas
from eventlens.functions import parse as P
from eventlens.functions.time import with_event_time, with_processing_time
from eventlens.operators import partition as PA
from eventlens.operators import windows as W
from eventlens.sources import read_lines, register_csv
from eventlens.streaming import forms as SF
from eventlens.streaming.runner import run_stream
from tests import fixtures as X


def write_lines(d, name, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def sensor_lines():
    return [f"{i},{t},{v}" for i, t, v in X.SENSOR]


def test_read_lines_and_csv_table(spark):
    d = tempfile.mkdtemp(prefix="lines-")
    write_lines(d, "sensor.txt", sensor_lines())
    parsed = P.valid_rows(P.parse_sensor(read_lines(spark, d)))
    assert parsed.count() == 7
    register_csv(spark, "sensor_csv", d, schemas.SENSOR)
    got = spark.sql("SELECT id, count(id) AS cnt FROM sensor_csv GROUP BY id").collect()
    assert {r.id: r.cnt for r in got}["sensor_1"] == 4


def test_streaming_lines_word_count(spark):
    d = tempfile.mkdtemp(prefix="words-")
    for i, w in enumerate(X.WORDS):
        write_lines(d, f"w{i}.txt", [w])
    lines = read_lines(spark, d, streaming=True, max_files_per_trigger=1)
    words = lines.select(F.explode(F.split("value", " ")).alias("word")).groupBy("word").count()
    q = run_stream(words, "s_words", sink="memory", mode="complete", checkpoint=tempfile.mkdtemp())
    q.awaitTermination()
    assert {r.word: r["count"] for r in spark.table("s_words").collect()}["hi"] == 3


def test_processing_time_window(spark):
    df = spark.createDataFrame(X.SENSOR, schemas.SENSOR)
    out = W.tumbling(with_processing_time(df), "proc_ts", "10 seconds", ["id"], [F.count(F.lit(1)).alias("cnt")])
    assert sum(r.cnt for r in out.collect()) == 7
    et = with_event_time(df, "timestamp", "s")
    assert str(et.schema["ts"].dataType) == "TimestampType()"


def test_partition_strategies(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    for strategy in ["hash", "shuffle", "rebalance", "global"]:
        p = PA.partition_by(df, strategy, 4, key="k")
        assert p.count() == 100
        assert p.rdd.getNumPartitions() == (1 if strategy == "global" else 4)
    h = PA.with_partition_id(PA.partition_by(df, "hash", 4, key="k"))
    per_key = h.groupBy("k").agg(F.countDistinct("part").alias("n")).collect()
    assert all(r.n == 1 for r in per_key)


def test_restart_resumes_from_checkpoint(spark):
    src = tempfile.mkdtemp(prefix="restart-src-")
    ck = tempfile.mkdtemp(prefix="restart-ck-")
    out = tempfile.mkdtemp(prefix="restart-out-")
    lines = sensor_lines()
    write_lines(src, "a.txt", lines[:4])

    def start():
        s = P.valid_rows(P.parse_sensor(read_lines(spark, src, streaming=True)))
        return run_stream(s, "restart_q", sink="parquet", path=out, checkpoint=ck)

    start().awaitTermination()
    write_lines(src, "b.txt", lines[4:])
    start().awaitTermination()  # resumes: only the new file is read
    got = spark.read.parquet(out)
    assert got.count() == 7 and got.distinct().count() == 7


def test_late_router(spark):
    src = tempfile.mkdtemp(prefix="late-src-")
    state = os.path.join(tempfile.mkdtemp(prefix="late-state-"), "wm")
    hour = 3_600_000
    write_lines(src, "1.csv", [f"1,{5 * hour + 10}"])                   # watermark becomes 5h+10 − 10min
    write_lines(src, "2.csv", [f"2,{3 * hour + 5}", f"3,{5 * hour - 1}"])  # 3h window purged; 4h window still open
    os.utime(os.path.join(src, "1.csv"), (1_000_000, 1_000_000))  # files are taken oldest first
    os.utime(os.path.join(src, "2.csv"), (2_000_000, 2_000_000))
    df = spark.readStream.schema("id long, ts_ms long").option("maxFilesPerTrigger", 1).csv(src)
    on_time, late = [], []
    route = SF.late_router("ts_ms", "1 hour", "10 minutes", "10 minutes",
                           lambda d, e: on_time.extend(r.id for r in d.collect()),
                           lambda d, e: late.extend(r.id for r in d.collect()), state)
    run_stream(df, "late_q", foreach_batch=route, checkpoint=tempfile.mkdtemp()).awaitTermination()
    assert sorted(on_time) == [1, 3] and late == [2]
