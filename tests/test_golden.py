"""Golden micro-tests: tiny inputs with hand-derived answers."""

import pytest
from pyspark.sql import functions as F

from eventlens import schemas
from eventlens.functions import parse as P
from eventlens.functions import text as TX
from eventlens.functions.hashing import poly_hash
from eventlens.operators import changelog as C
from eventlens.operators import distinct as D
from eventlens.operators import fold as FO
from eventlens.operators import partition as PA
from eventlens.operators import patterns as PT
from eventlens.operators import rolling as R
from eventlens.operators import routing as RT
from eventlens.operators import rules as RU
from eventlens.operators import tables as TB
from eventlens.operators import topn as N
from eventlens.operators import windows as W
from eventlens.sources import from_rows
from tests import fixtures as X


@pytest.fixture(params=["single", "split"])
def plan(request, monkeypatch):
    """Run order-dependent operators both as one pass and as the split plan."""
    if request.param == "split":
        monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "2")
    return request.param


def sensors(spark):
    df = from_rows(spark, X.SENSOR, schemas.SENSOR, arrival="arrival")
    return df.withColumn("ts", F.timestamp_seconds("timestamp")).withColumn(
        "temp_cents", F.round(F.col("temperature") * 100).cast("bigint"))


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_rolling_max_by(spark, plan):
    out = R.rolling_max_by(sensors(spark).select("id", "arrival", "timestamp", "temperature"),
                           "id", "arrival", "temperature", carry=["timestamp"])
    got = sorted(rows(out.where("id = 'sensor_1'"), "arrival", "max_timestamp", "max_temperature"))
    assert [(t % 1000, v) for _, t, v in got] == [(199, 35.8), (207, 36.3), (207, 36.3), (212, 37.1)]


def test_rolling_latest_max(spark, plan):
    out = R.rolling_latest_max(sensors(spark).select("id", "arrival", "timestamp", "temperature"),
                               "id", "arrival", "temperature")
    got = sorted(rows(out.where("id = 'sensor_1'"), "arrival", "timestamp", "temperature"))
    assert [(t % 1000, v) for _, t, v in got] == [(199, 35.8), (207, 36.3), (209, 36.3), (212, 37.1)]


def test_rolling_count(spark, plan):
    out = R.rolling_count(sensors(spark), "id", "arrival")
    got = sorted(rows(out, "id", "arrival", "cnt"))
    assert [c for i, _, c in got if i == "sensor_1"] == [1, 2, 3, 4]
    assert all(c == 1 for i, _, c in got if i != "sensor_1")


def test_window_min_by(spark):
    out = W.window_min_by(sensors(spark), "ts", "15 seconds", ["id"], "temperature", "arrival", carry=["timestamp"])
    got = sorted(rows(out, "id", "window_end", "timestamp", "temperature"))
    assert got == sorted([
        ("sensor_1", 1547718210000, 1547718209, 32.8), ("sensor_1", 1547718225000, 1547718212, 37.1),
        ("sensor_6", 1547718210000, 1547718201, 15.4), ("sensor_7", 1547718210000, 1547718202, 6.7),
        ("sensor_10", 1547718210000, 1547718205, 38.1)])


@pytest.mark.parametrize("strategy", ["direct", "panes"])
def test_sliding_count_groups(spark, strategy):
    out = W.sliding_count(sensors(spark), "ts", "10 seconds", "2 seconds", ["id"], strategy=strategy)
    assert out.count() == 27


def test_count_window_avg(spark, plan):
    out = R.count_window(sensors(spark), "id", "arrival", "temperature", size=10, slide=2)
    got = sorted(rows(out, "id", "n", "avg_temp"))
    assert got == [("sensor_1", 2, 36.05), ("sensor_1", 4, 35.5)]


def test_jump_alarm(spark, plan):
    s = sensors(spark)
    assert RU.jump_alarm(s, "id", "arrival", "temperature", 10.0).count() == 0
    got = rows(RU.jump_alarm(s, "id", "arrival", "temperature", 4.0), "id", "last_temperature", "temperature")
    assert got == [("sensor_1", 32.8, 37.1)]


def test_rising_alarm(spark, plan):
    out = FO.rising_alarm(sensors(spark), 10, arrival="arrival")
    got = sorted(rows(out, "id", "armed_ts", "fired_ts"), key=lambda r: r[1])
    assert [(i, a % 1000, f % 1000) for i, a, f in got] == [
        ("sensor_6", 201, 211), ("sensor_7", 202, 212), ("sensor_10", 205, 215), ("sensor_1", 212, 222)]


def test_split_comap_union(spark):
    s = sensors(spark).select("id", "timestamp", "temperature")
    parts = RT.split_by(s, {"high": F.col("temperature") > 30, "low": F.col("temperature") <= 30})
    assert parts["high"].count() == 5 and parts["low"].count() == 2
    cm = RT.co_map(parts["high"], lambda d: d.select("id", "temperature", F.lit("high warning").alias("status")),
                   parts["low"], lambda d: d.select("id", "temperature", F.lit("normal").alias("status")))
    statuses = sorted(r.status for r in cm.collect())
    assert statuses == ["high warning"] * 5 + ["normal"] * 2
    assert RT.union_all(parts["high"], parts["low"], s).count() == 14
    routed = RT.with_route(s.union(spark.createDataFrame([("x", 1, None)], s.schema)),
                           {"high": F.col("temperature") > 30, "low": F.col("temperature") <= 30})
    assert sorted(r.route for r in routed.collect()).count("unrouted") == 1


def test_prefix_and_select(spark):
    s = sensors(spark)
    assert s.where(F.col("id").startswith("sensor_1")).count() == 5
    s.createOrReplaceTempView("sensor_t")
    assert spark.table("sensor_t").select("id", "temperature").filter("id = 'sensor_1'").count() == 4


def test_sensor_stats(spark):
    s = sensors(spark)
    want = [("sensor_1", 4, 35.5), ("sensor_10", 1, 38.1), ("sensor_6", 1, 15.4), ("sensor_7", 1, 6.7)]
    assert sorted(rows(TB.sensor_stats(s), "id", "cnt", "avg_temp")) == want
    assert sorted(rows(TB.sensor_stats_sql(spark, s), "id", "cnt", "avg_temp")) == want


def test_changelog(spark, plan):
    out = C.changelog_count_avg(sensors(spark), "id", "arrival", "temperature")
    got = sorted(rows(out.where("id = 'sensor_1'"), "arrival", "seq", "op", "cnt", "avg_temp"))
    assert [(o, c, a) for _, _, o, c, a in got] == [
        ("+", 1, 35.8), ("-", 1, 35.8), ("+", 2, 36.05), ("-", 2, 36.05), ("+", 3, 34.9667),
        ("-", 3, 34.9667), ("+", 4, 35.5)]


def test_partition_custom(spark):
    p = PA.with_partition_id(PA.partition_by(sensors(spark), "custom", 4, key="timestamp"))
    got = sorted(rows(p, "arrival", "part"))
    assert [x for _, x in got] == [3, 1, 2, 1, 3, 1, 0]


def test_words(spark):
    lines = spark.createDataFrame([(w,) for w in X.WORDS], "value string")
    counts = dict(rows(R.word_count(lines, "value"), "word", "cnt"))
    assert counts == {"hi": 3, "hello": 2, "c": 1, "welcome": 1, "hhh": 1}
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(X.WORDS)], "doc_id bigint, text string")
    assert R.rolling_sum(docs).count() == 8


def test_java_split_edges(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (" ",)], "value string")
    got = [r.t for r in df.select(TX.split_dropping_trailing("value").alias("t")).collect()]
    assert got == [["a", "", "b"], [""], []]


LOGIN_PREFIX = 1558430000


def logins(spark):
    return from_rows(spark, X.LOGINS, schemas.LOGIN, arrival="event_id")


def test_login_fail_timer(spark, plan):
    got = sorted(rows(FO.login_fail_timer(logins(spark), 2, 2), "user_id", "first_fail_time",
                      "last_fail_time", "warning_msg"))
    assert [(u, f - LOGIN_PREFIX, l - LOGIN_PREFIX, m) for u, f, l, m in got] == [
        (1035, 842, 843, "login fail 2"), (5692, 832, 834, "login fail 3"), (23064, 826, 827, "login fail 2")]


def test_login_fail_pairs(spark, plan):
    got = sorted(rows(RU.login_fail_pairs(logins(spark), 2), "user_id", "first_fail_time", "last_fail_time"))
    assert [(u, f - LOGIN_PREFIX, l - LOGIN_PREFIX) for u, f, l in got] == [
        (1035, 842, 843), (1035, 843, 845), (5692, 832, 833), (5692, 833, 834), (23064, 826, 827)]


def test_login_fail_times(spark, plan):
    got = rows(PT.login_fail_times(logins(spark), 3, 3), "user_id", "first_fail_time", "last_fail_time",
               "warning_msg")
    assert [(u, f - LOGIN_PREFIX, l - LOGIN_PREFIX, m) for u, f, l, m in got] == [
        (5692, 832, 834, "login fail 3 times")]
    fail = F.col("login_state") == "fail"
    m = PT.select_match(PT.match_sequence(logins(spark), "user_id", "timestamp", "event_id",
                                          [fail, fail, fail], 3), "failEvents")
    r = m.collect()
    assert len(r) == 1 and len(r[0].matches["failEvents"]) == 3


def behaviour(spark):
    df = from_rows(spark, X.BEHAVIOUR, schemas.BEHAVIOR, arrival="event_id")
    return df.withColumn("ts", F.timestamp_seconds("timestamp"))


def test_page_views_and_uv(spark):
    pv = behaviour(spark).where("behavior = 'pv'")
    want_pv = [(1511661600000, 4), (1511665200000, 1)]
    assert sorted(rows(D.page_views(pv), "window_end", "cnt")) == want_pv
    assert sorted(rows(D.page_views_salted(pv, "event_id", 10), "window_end", "cnt")) == want_pv
    want_uv = [(1511661600000, 2), (1511665200000, 1)]
    assert sorted(rows(D.unique_visitors(pv), "window_end", "uv")) == want_uv
    assert sorted(rows(D.uv_bitmap(pv), "window_end", "uv")) == want_uv
    assert sorted(rows(D.uv_approx(pv), "window_end", "uv")) == want_uv


def test_uv_running(spark, plan):
    pv = behaviour(spark).where("behavior = 'pv'")
    got = sorted(rows(D.uv_running(pv), "window_end", "uv"))
    assert got == [(1511661600000, 1), (1511661600000, 2), (1511665200000, 1)]


def test_hash_check_value(spark):
    assert spark.range(1).select(poly_hash(F.lit("5402")).alias("h")).first().h == 861875


def test_hot_items(spark):
    top = N.hot_items(behaviour(spark), n=5, size="1 hour", slide="5 minutes")
    got = sorted(rows(top.where("window_end = 1511661600000"), "rn", "item_id", "cnt"))
    assert got == [(1, 10, 2), (2, 20, 2)]
    sql = N.hot_items_sql(spark, behaviour(spark))
    assert sorted(rows(sql, "window_end", "rn", "item_id", "cnt")) == sorted(rows(top, "window_end", "rn", "item_id", "cnt"))
    report = N.format_ranking(top).where("window_end = 1511661600000").first().report
    assert report.splitlines()[1:] == ["NO 1: item_id=10 count=2", "NO 2: item_id=20 count=2"]


def test_access_log(spark):
    lines = spark.createDataFrame([(x,) for x in X.ACCESS_LOG + ["garbage"]], "value string")
    parsed = P.parse_access_log(lines)
    assert P.corrupt_rows(parsed).count() == 1
    ok = P.valid_rows(parsed)
    assert ok.orderBy("timestamp").first().timestamp == 1431857103000
    kept = TX.drop_static_assets(ok.where("method = 'GET'"))
    assert sorted(r.url for r in kept.collect()) == ["/a.css?x=1", "/index.html", "/index.html"]
    log = ok.withColumn("ts", F.timestamp_millis("timestamp"))
    top = N.hot_pages(log, n=3, size="10 minutes", slide="5 seconds")
    # a window covering all five lines
    w = top.where("window_end = 1431857110000")
    assert sorted(rows(w, "url", "cnt")) == [("/a.css?x=1", 1), ("/index.html", 2)]


def test_parsers_keep_bad_lines(spark):
    lines = spark.createDataFrame([("sensor_1,1547718199,35.8",), ("sensor_x,notanumber,1",)], "value string")
    p = P.parse_sensor(lines)
    assert P.valid_rows(p).count() == 1 and P.corrupt_rows(p).count() == 1
    lg = spark.createDataFrame([("5402,83.149.11.115,success,1558430815",)], "value string")
    assert P.valid_rows(P.parse_login(lg)).first().user_id == 5402
    bh = spark.createDataFrame([("1,10,100,pv,1511658000",)], "value string")
    assert P.valid_rows(P.parse_behavior(bh)).first().behavior == "pv"


def test_timer_rules_long_segment_path(spark, monkeypatch):
    """Segments longer than the fold chunk take the pointer-doubling path."""
    monkeypatch.setenv("EVENTLENS_FOLD_CHUNK", "1")
    got = sorted(rows(FO.login_fail_timer(logins(spark), 2, 2), "user_id", "first_fail_time", "last_fail_time"))
    assert [(u, f - LOGIN_PREFIX, l - LOGIN_PREFIX) for u, f, l in got] == [
        (1035, 842, 843), (5692, 832, 834), (23064, 826, 827)]
    out = FO.rising_alarm(sensors(spark), 10, arrival="arrival")
    got = sorted((i, a % 1000, f % 1000) for i, a, f in rows(out, "id", "armed_ts", "fired_ts"))
    assert got == sorted([("sensor_6", 201, 211), ("sensor_7", 202, 212), ("sensor_10", 205, 215),
                          ("sensor_1", 212, 222)])
