"""Metamorphic and brute-force checks."""

import random

import pytest
from pyspark.sql import functions as F

from eventlens.operators import distinct as D
from eventlens.operators import lateness as LT
from eventlens.operators import rolling as R
from eventlens.operators import routing as RT
from eventlens.operators import udf as U
from eventlens.operators import windows as W
from eventlens.plans import adapters as A
from eventlens.sinks import labelled, with_metrics
from eventlens.sources.generator import register_sensor_walk, sensor_walk

SF = "/root/testdata/sf0.001"


def brute_late(rows, size, delay, lateness):
    """rows: (id, ts_ms, arrival). Plain-Python reference of the lateness model."""
    out = {}
    seen_max = None
    for rid, ts, arr in sorted(rows, key=lambda r: (r[2], r[0])):
        end = (ts // size + 1) * size
        wm = None if seen_max is None else seen_max - delay
        out[rid] = wm is not None and end - 1 + lateness <= wm
        seen_max = ts if seen_max is None else max(seen_max, ts)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("split", [False, True])
def test_lateness_matches_brute_force(spark, seed, split, monkeypatch):
    if split:
        monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "7")
    rnd = random.Random(seed)
    rows = []
    for i in range(120):
        ts = rnd.randrange(0, 4 * 3_600_000)
        rows.append((i, ts, ts + rnd.randrange(0, 1_800_000) * rnd.choice([0, 1, 1])))
    df = spark.createDataFrame(rows, "id long, ts_ms long, arrival long")
    m = LT.mark_late(df, "ts_ms", ["arrival", "id"], "1 hour", "5 minutes", "10 minutes")
    got = {r.id: r.late for r in m.collect()}
    assert got == brute_late(rows, 3_600_000, 300_000, 600_000)


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("10 minutes", "4 minutes"), ("30 seconds", "30 seconds")])
def test_panes_equal_direct(spark, size, slide):
    ev = A.behaviour(spark.read.parquet(f"{SF}/events.parquet"))
    a = W.sliding_count(ev, "ts", size, slide, ["item_id"], strategy="direct")
    b = W.sliding_count(ev, "ts", size, slide, ["item_id"], strategy="panes")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_salted_equals_plain_and_bitmap_bounded(spark):
    pv = A.behaviour(spark.read.parquet(f"{SF}/events.parquet"))
    assert D.page_views(pv).exceptAll(D.page_views_salted(pv, "event_id", 7)).count() == 0
    exact = {r.window_end: r.uv for r in D.unique_visitors(pv).collect()}
    for r in D.uv_bitmap(pv).collect():
        assert r.uv <= exact[r.window_end]
    for r in D.uv_approx(pv).collect():
        assert abs(r.uv - exact[r.window_end]) <= max(1, 0.05 * exact[r.window_end])


def test_union_count_is_sum(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    a, b = ev.where("value > 30"), ev.where("value <= 30")
    assert RT.union_all(a, b, ev).count() == a.count() + b.count() + ev.count()


def test_global_sequence_is_row_number(spark, monkeypatch):
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "50")
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id")
    seq = [r.seq for r in R.global_sequence(ev, "event_id").orderBy("event_id").collect()]
    assert seq == list(range(1, len(seq) + 1))


def test_keyed_aggregate_and_reduce(spark, monkeypatch):
    monkeypatch.setenv("EVENTLENS_AGG_CHUNK", "3")
    ev = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_id", "value")
    got = U.keyed_aggregate(ev, ["user_id"], F.col("value"),
                            zero=F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n")),
                            add=lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["n"] + 1).alias("n")),
                            merge=lambda a, b: F.struct((a["s"] + b["s"]).alias("s"), (a["n"] + b["n"]).alias("n")),
                            result=lambda acc: acc["n"])
    want = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("result"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    red = U.keyed_reduce(ev, ["user_id"], ["event_id"], F.col("value"), lambda a, b: F.greatest(a, b))
    want = ev.groupBy("user_id").agg(F.max("value").alias("result"))
    assert red.exceptAll(want).count() == 0 and want.exceptAll(red).count() == 0


def test_sensor_walk_reproducible(spark):
    a = sensor_walk(spark, 3, 20, seed=5)
    b = sensor_walk(spark, 3, 20, seed=5)
    assert a.count() == 60 and a.exceptAll(b).count() == 0
    register_sensor_walk(spark)
    ds = spark.read.format("sensor_walk").option("sensors", 2).option("steps", 5).load()
    assert ds.count() == 10 and {r.id for r in ds.collect()} == {"sensor_1", "sensor_2"}


def test_metrics_and_labels(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    observed, obs = with_metrics(df, "send", ok=F.col("x") != 2)
    observed.collect()
    assert obs.get == {"sent": 3, "errors": 1}
    assert [r.value for r in labelled(df.limit(1), "out").collect()] == ["out> 1"]


def test_map_partitions_lifecycle(spark):
    df = spark.createDataFrame([("sensor_1",), ("sensor_10",)], "id string")

    def fn(pdf, ctx):
        return pdf.assign(len=pdf["id"].str.len().astype("int32") + ctx["offset"])

    out = U.map_partitions_with_setup(df, fn, "id string, len int", setup=lambda: {"offset": 0},
                                      teardown=lambda ctx: None)
    assert sorted(r.len for r in out.collect()) == [8, 9]


def test_burst_is_split_across_buckets(spark, monkeypatch):
    """A third of the rows in a narrow burst of the order column still spread
    over buckets of about the target size."""
    from eventlens.operators.prefix import BUCKET, Prefix, running_aggregates, with_range_bucket
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "100")
    spread = spark.range(2000).select((F.col("id") * 500_000).alias("t"), F.lit("hot").alias("k"))
    burst = spark.range(1000).select((F.lit(500_000_001) + F.col("id") * 1000).alias("t"), F.lit("hot").alias("k"))
    df = spread.unionByName(burst)
    b = with_range_bucket(df, "t")
    sizes = [r["count"] for r in b.groupBy(BUCKET).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 200 and len(sizes) >= 15
    r = running_aggregates(df.withColumn("a", F.col("t")), ["k"], ["t"], {"n": Prefix("count")})
    got = [x.n for x in r.orderBy("t").collect()]
    assert got == list(range(1, 3001))
