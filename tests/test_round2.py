"""Averages below zero, NULL order values, gaps between windows, uncut lists."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlens.operators import rolling as R
from eventlens.operators import tables as T
from eventlens.operators import windows as W


def test_averages_below_zero(spark):
    rows = spark.createDataFrame([("a", -35.55), ("b", -1.0), ("b", 0.0), ("b", 0.0), ("c", -0.01), ("c", 0.02), ("d", 0.00025), ("d", 0.00004),
                                  ("e", 1.0), ("e", None), ("e", float("nan")), ("f", None), ("g", 1e15), ("g", 1e15)], "id string, temperature double")
    want = {("a", 1, -35.55), ("b", 3, -0.3333), ("c", 2, 0.005), ("d", 2, 0.0001), ("e", 3, 1.0), ("f", 1, None), ("g", 2, 1e15)}
    assert {tuple(r) for r in T.sensor_stats(rows).collect()} == want
    assert {tuple(r) for r in T.sensor_stats_sql(spark, rows).collect()} == want
    assert {tuple(r) for r in T.sensor_stats(rows.withColumn("temperature", F.col("temperature").cast("float"))).where("id = 'b'").collect()} == {("b", 3, -0.3333)}


def test_averages_of_plain_doubles_in_count_windows_changelog_and_sums(spark):
    from eventlens.operators import changelog as C
    values = [-250.125, 0.333, None, 7.5, -1e-5, 3.0]
    rows = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "id string, at long, t double")
    rows = rows.withColumn("ts", F.timestamp_seconds("at"))

    def avg(part):
        known = [round(v * 10 ** 8) for v in part if v is not None]
        return ((2 * sum(known) * 10_000 + len(known) * 10 ** 8) // (2 * len(known) * 10 ** 8)) / 10_000

    got = {r.n: r.avg_temp for r in R.count_window(rows, "id", "at", "t", size=3, slide=2).collect()}
    assert got == {n: avg(values[max(0, n - 3):n]) for n in (2, 4, 6)}
    log = C.changelog_count_avg(rows, "id", "at", "t")
    assert {r.cnt: r.avg_temp for r in log.where("op = '+'").collect()} == {n: avg(values[:n]) for n in range(1, 7)}
    assert {r.cnt: r.avg_temp for r in log.where("op = '-'").collect()} == {n: avg(values[:n]) for n in range(1, 6)}
    assert W.window_sum_keep_first(rows, "ts", "1 hour", ["id"], "t", "at").first()["t"] == -239.29201


@pytest.mark.parametrize("split", [False, True])
def test_running_count_with_null_and_odd_order_values(spark, monkeypatch, split):
    if split:
        monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "3")
    values = [None, float("-inf"), *map(float, range(-5, 12)), 1e15, float("inf"), float("nan")]
    df = spark.createDataFrame([("k", v) for v in values], "id string, o double")
    got = {repr(r.o): r.n for r in R.rolling_count(df, "id", "o", "n").collect()}
    assert got == {repr(v): i + 1 for i, v in enumerate(values)}


@pytest.mark.parametrize("strategy", ["panes", "panes_shuffle", "direct"])
def test_windows_with_gaps(spark, strategy):
    at = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc)
    df = spark.createDataFrame([(at(s),) for s in (0, 9, 15, 29, 30, 65)], "ts timestamp")
    got = {tuple(r) for r in W.sliding_count(df, "ts", "10 seconds", "30 seconds", strategy=strategy).select("window_end", "cnt").collect()}
    assert got == {(10_000, 2), (40_000, 1), (70_000, 1)}


def test_keyed_list_is_uncut(spark):
    df = spark.createDataFrame([("k", i, i * i) for i in range(100)], "id string, at long, v long")
    assert [(r.position, r.item) for r in R.keyed_list(df, "id", "at", "v").orderBy("position").collect()] == [(i + 1, i * i) for i in range(100)]


def test_buckets_of_odd_order_values(spark, monkeypatch):
    """Outliers, NULLs, texts, dates and equal first columns: even buckets, one numbering."""
    from eventlens.operators.prefix import BUCKET, with_range_bucket
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "500")
    base = spark.range(5000).select("id", F.lit("hot").alias("k"))
    kinds = {
        "outliers": [F.when(F.col("id") == 0, 0).when(F.col("id") == 1, 253_402_300_799_000).otherwise(1_700_000_000_000 + F.col("id"))],
        "equal": [F.lit(7), F.col("id")], "text": [F.format_string("%08d", "id")],
        "date": [F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))],
        "nulls": [F.when(F.col("id") % 3 > 0, -F.col("id")), F.col("id")]}
    for name, cols in kinds.items():
        order = [f"o{i}" for i in range(len(cols))]
        df = base.select("id", "k", *[c.alias(o) for c, o in zip(cols, order, strict=True)])
        sizes = [r["count"] for r in with_range_bucket(df, order).groupBy(BUCKET).count().collect()]
        assert sum(sizes) == 5000 and max(sizes) <= 1000, name
        split = R.running_aggregates(df, ["k"], order, {"n": R.Prefix("count")}).select("id", "n")
        want = df.selectExpr("id", f"row_number() over (partition by k order by {', '.join(order)}) as n")
        assert split.exceptAll(want).isEmpty() and split.count() == 5000, name


def test_rise_after_a_null_reading(spark):
    from eventlens.operators import fold as FO
    rows = [("s", 1, 1, 5.0), ("s", 2, 2, None), ("s", 3, 3, 9.0), ("s", 4, 4, 10.0)]
    df = spark.createDataFrame(rows, "id string, timestamp long, event_id long, temperature double")
    got = [(r.armed_ts, r.fired_ts) for r in FO.rising_alarm(df, 10).collect()]
    assert got == [(4, 14)]  # the NULL cancels the alarm of time 1; 9.0 has nothing to rise from


def test_sliding_lateness_against_a_row_by_row_model(spark):
    import random
    from collections import Counter
    from eventlens.operators import lateness as LT
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(0, 60_000), rnd.choice("ab")) for i in range(300)]
    df = spark.createDataFrame(rows, "at long, ts_ms long, url string")
    m = LT.mark_late_sliding(df, "ts_ms", ["at"], "10 seconds", "3 seconds", "2 seconds", "40 seconds")
    counts, late, seen = Counter(), set(), None
    for at, t, url in rows:
        ends = [s + 10_000 for s in range(t // 3000 * 3000, t - 10_000, -3000)]
        still = [e for e in ends if seen is None or e - 1 + 40_000 > seen - 2000]
        counts.update((url, e) for e in still)
        late |= set() if still else {at}
        seen = t if seen is None else max(seen, t)
    assert late and {r["at"] for r in m.where("late").collect()} == late
    assert {(r.url, r.window_end): r.cnt for r in LT.corrected_counts(m, ["url"], "10 seconds", "3 seconds").collect()} == counts


def test_restart_policy_resumes(spark):
    from eventlens.streaming.runner import restart_policy

    class Query:
        def __init__(self, fails):
            self.fails = fails

        def awaitTermination(self):
            if self.fails:
                raise RuntimeError("lost")

    runs = iter([True, True, False])
    assert restart_policy(3, 0)(lambda: Query(next(runs))).fails is False
    with pytest.raises(RuntimeError):
        restart_policy(1, 0)(lambda: Query(True))


def test_topic_options():
    from eventlens.sources.topic import topic_options
    got = topic_options("a:1", "logs", "earliest", **{"group.id": "g", "kafka.session.timeout.ms": 5})
    assert got == {"kafka.bootstrap.servers": "a:1", "subscribe": "logs", "startingOffsets": "earliest",
                   "kafka.group.id": "g", "kafka.session.timeout.ms": "5"}


def test_event_table(spark):
    from eventlens.operators.tables import as_event_table
    df = spark.range(3).select("id", F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("unused"))
    assert as_event_table(df, "ev", ["id", "ts"], "ts", "1 second").columns == ["id", "ts"]
    assert spark.sql("select max(id) m from ev").first().m == 2


def test_one_pass_routes_keep_duplicates_and_drop_nulls(spark):
    from eventlens.operators import routing as RT
    df = spark.createDataFrame([(1, 40.0), (2, 20.0), (3, None)], "id long, t double")
    t, cols = F.col("t"), [F.col("id")]
    out = RT.map_routes(df, {"high": (t > 30, cols), "low": (t <= 30, cols), "all": (t.isNotNull(), cols)})
    assert sorted(r.id for r in out.collect()) == [1, 1, 2, 2]
    assert out._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
