"""Registered queries: one callable (spark, sf_dir) → DataFrame per analysis.

Every query reads the driver's tables (through the adapters) over their
whole extent; nothing is sampled or capped except where the cap is the
feature (top-n ranks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions import parse as P
from eventlens.plans import adapters as A
from eventlens.operators import distinct as D
from eventlens.operators import topn as N
from eventlens.operators import windows as W

REGISTRY: dict = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _events(spark, sf):
    return A.table(spark, sf, "events")


def _views(spark, sf):
    return A.behaviour(_events(spark, sf), pv_only=True).where(F.col("behavior") == "pv")


def _log(spark, sf) -> DataFrame:
    lines = A.access_log_lines(_events(spark, sf), A.table(spark, sf, "pages"))
    parsed = P.valid_rows(P.parse_access_log(lines))
    return parsed.withColumn("ts", F.timestamp_millis("timestamp"))


# --- top-n ---------------------------------------------------------------

@query
def hot_items(spark: SparkSession, sf: str) -> DataFrame:
    return N.hot_items(A.behaviour(_events(spark, sf), pv_only=True), n=5, size="1 hour", slide="5 minutes")


@query
def hot_items_sql(spark: SparkSession, sf: str) -> DataFrame:
    return N.hot_items_sql(spark, A.behaviour(_events(spark, sf), pv_only=True), n=5)


@query
def hot_pages(spark: SparkSession, sf: str) -> DataFrame:
    return N.hot_pages(_log(spark, sf), n=3, size="10 minutes", slide="5 seconds")


# --- windows and counts --------------------------------------------------

@query
def page_views(spark, sf):
    return D.page_views(_views(spark, sf))


@query
def page_views_salted(spark, sf):
    return D.page_views_salted(_views(spark, sf), "event_id", 10)


@query
def unique_visitors(spark, sf):
    return D.unique_visitors(_views(spark, sf))


@query
def uv_bitmap(spark, sf):
    return D.uv_bitmap(_views(spark, sf))


@query
def uv_running(spark, sf):
    return D.uv_running(_views(spark, sf))


@query
def uv_approx(spark, sf):
    """Exact visitors, and whether the sketch is within five standard errors (or one)."""
    views, rsd = _views(spark, sf), 0.01
    sketch = D.uv_approx(views, rsd=rsd).withColumnRenamed("uv", "sketch")
    j = D.unique_visitors(views).join(sketch, "window_end")
    off = F.abs(F.col("sketch") - F.col("uv"))
    return j.select("window_end", "uv", (off <= F.greatest(F.lit(1.0), 5 * rsd * F.col("uv"))).alias("within"))


@query
def tumbling_min_by(spark, sf):
    r = A.readings(_events(spark, sf))
    return W.window_min_by(r, "ts", "1 hour", ["id"], "temperature", "event_id", carry=["timestamp"])


@query
def tumbling_sum_keep_first(spark, sf):
    r = A.readings(_events(spark, sf))
    s = W.window_sum_keep_first(r, "ts", "1 hour", ["id"], "temperature", "event_id", carry=["timestamp"])
    return s.select("id", "window_end", "event_id", "timestamp", "temperature")


@query
def sliding_count(spark, sf):
    r = A.readings(_events(spark, sf))
    return W.sliding_count(r, "ts", "1 hour", "10 minutes", keys=["id"], strategy="direct")


# --- rolling aggregates, count windows, changelog -------------------------

from eventlens.operators import rolling as R  # noqa: E402
from eventlens.operators import changelog as C  # noqa: E402


def _readings(spark, sf):
    return A.readings(_events(spark, sf))


@query
def word_count(spark, sf):
    return R.word_count(A.documents(spark, sf))


@query
def rolling_sum(spark, sf):
    return R.rolling_sum(A.documents(spark, sf))


@query
def rolling_count(spark, sf):
    return R.rolling_count(_readings(spark, sf).select("id", "event_id"), "id", "event_id")


@query
def rolling_max_by(spark, sf):
    r = _readings(spark, sf).select("id", "event_id", "timestamp", "temperature")
    return R.rolling_max_by(r, "id", "event_id", "temperature", carry=["timestamp"])


@query
def rolling_min_by(spark, sf):
    r = _readings(spark, sf).select("id", "event_id", "timestamp", "temperature")
    return R.rolling_min_by(r, "id", "event_id", "temperature", carry=["timestamp"])


@query
def rolling_latest_max(spark, sf):
    r = _readings(spark, sf).select("id", "event_id", "timestamp", "temperature")
    return R.rolling_latest_max(r, "id", "event_id", "temperature")


@query
def keyed_history(spark, sf):
    r = _readings(spark, sf).select("id", "event_id")
    return R.keyed_list(r, "id", "event_id", "event_id")


@query
def latest_value_map(spark, sf):
    e = _events(spark, sf).select("user_id", "event_type", "value", "event_id")
    return R.latest_value_map(e, "user_id", "event_type", "value", "event_id")


@query
def global_sequence(spark, sf):
    return R.global_sequence(_events(spark, sf).select("event_id", "user_id"), "event_id")


@query
def count_window_avg(spark, sf):
    r = _readings(spark, sf).select("id", "event_id", "temperature")
    return R.count_window(r, "id", "event_id", "temperature", size=10, slide=2)


@query
def changelog_stats(spark, sf):
    r = _readings(spark, sf).select("id", "event_id", "temperature")
    return C.changelog_count_avg(r, "id", "event_id", "temperature")


# --- rules, patterns, timer folds -------------------------------------------

from eventlens.operators import fold as FO  # noqa: E402
from eventlens.operators import patterns as PT  # noqa: E402
from eventlens.operators import rules as RU  # noqa: E402

# Windows of the login rules are scaled to the driver's data (150 users over
# 30 days at sf0.01): hours instead of seconds.
PAIR_WITHIN_S = 3600
TIMES_WITHIN_S = 86400
TIMER_WITHIN_S = 86400
RISE_INTERVAL_S = 3600


def _logins(spark, sf):
    return A.logins(_events(spark, sf))


@query
def jump_alarm(spark, sf):
    return RU.jump_alarm(_readings(spark, sf), "id", "event_id", "temperature", 10.0)


@query
def login_fail_pairs(spark, sf):
    return RU.login_fail_pairs(_logins(spark, sf), PAIR_WITHIN_S)


@query
def match_times3(spark, sf):
    return PT.login_fail_times(_logins(spark, sf), 3, TIMES_WITHIN_S)


@query
def match_sequence(spark, sf):
    lg = _logins(spark, sf)
    fail = F.col("login_state") == "fail"
    m = PT.match_sequence(lg, "user_id", "timestamp", "event_id", [fail, fail, fail], TIMES_WITHIN_S)
    m = PT.select_match(m, "failEvents")
    return m.select("user_id", F.col("first.timestamp").alias("first_fail_time"),
                    F.col("last.timestamp").alias("last_fail_time"),
                    F.concat(F.lit("login fail "), F.size(F.col("matches")["failEvents"]).cast("string"),
                             F.lit(" times")).alias("warning_msg"))


@query
def login_fail_timer(spark, sf):
    return FO.login_fail_timer(_logins(spark, sf), 2, TIMER_WITHIN_S)


@query
def rising_alarm(spark, sf):
    return FO.rising_alarm(_readings(spark, sf), RISE_INTERVAL_S)


# --- routing, partitioning, tables -----------------------------------------

from eventlens.functions import text as TX  # noqa: E402
from eventlens.operators import lateness as LT  # noqa: E402
from eventlens.operators import partition as PA  # noqa: E402
from eventlens.operators import routing as RT  # noqa: E402
from eventlens.operators import tables as TB  # noqa: E402
from eventlens.operators import udf as U  # noqa: E402

SENSOR_COLS = ["id", "event_id", "timestamp", "temperature"]


def _sensor(spark, sf):
    return _readings(spark, sf).select(*SENSOR_COLS)


def _high_low(spark, sf):
    return RT.split_by(_sensor(spark, sf), {"high": F.col("temperature") > 30,
                                            "low": F.col("temperature") <= 30})


@query
def split_high(spark, sf):
    return _high_low(spark, sf)["high"]


@query
def split_low(spark, sf):
    return _high_low(spark, sf)["low"]


@query
def side_output_low(spark, sf):
    _, side = RT.route_to(_sensor(spark, sf), F.col("temperature") > 30,
                          {"low": F.col("temperature") <= 30})
    return side["low"]


@query
def co_map(spark, sf):
    cols = [F.col(c) for c in ("id", "event_id", "temperature")]
    return RT.map_routes(_sensor(spark, sf), {
        "high": (F.col("temperature") > 30, [*cols, F.lit("high warning").alias("status")]),
        "low": (F.col("temperature") <= 30, [*cols, F.lit("normal").alias("status")])})


@query
def union_all(spark, sf):
    cols = [F.col(c) for c in SENSOR_COLS]
    t = F.col("temperature")
    return RT.map_routes(_sensor(spark, sf), {"high": (t > 30, cols), "low": (t <= 30, cols), "all": (t.isNotNull(), cols)})


@query
def partition_custom(spark, sf):
    p = PA.partition_by(_sensor(spark, sf), "custom", 4, key="timestamp")
    return PA.with_partition_id(p).groupBy("part").agg(F.count(F.lit(1)).alias("cnt"))


@query
def sensor_stats(spark, sf):
    return TB.sensor_stats(_readings(spark, sf))


@query
def sensor_stats_sql(spark, sf):
    return TB.sensor_stats_sql(spark, _readings(spark, sf))


@query
def table_select(spark, sf):
    _sensor(spark, sf).createOrReplaceTempView("sensor_table")
    return spark.table("sensor_table").select("id", "temperature").filter("id = 'sensor_1'")


@query
def prefix_filter(spark, sf):
    return _sensor(spark, sf).where(F.col("id").startswith("sensor_1")).select("id", "event_id")


# --- parsing and text --------------------------------------------------------

def _sensor_lines(spark, sf):
    r = _sensor(spark, sf)
    return r.select("event_id", F.concat_ws(",", "id", F.col("timestamp").cast("string"),
                                            F.col("temperature").cast("string")).alias("value"))


@query
def parse_sensor_lines(spark, sf):
    return P.valid_rows(P.parse_sensor(_sensor_lines(spark, sf)))


def _behaviour_lines(spark, sf):
    return A.broken_lines(A.behaviour(_events(spark, sf)), ["user_id", "item_id", "category_id", "behavior", "timestamp"])


def _login_lines(spark, sf):
    return A.broken_lines(_logins(spark, sf), ["user_id", "ip", "login_state", "timestamp"])


@query
def parse_behavior_lines(spark, sf):
    return P.valid_rows(P.parse_behavior(_behaviour_lines(spark, sf)))


@query
def parse_behavior_corrupt(spark, sf):
    return P.corrupt_rows(P.parse_behavior(_behaviour_lines(spark, sf))).withColumnRenamed("_line", "line")


@query
def parse_login_lines(spark, sf):
    return P.valid_rows(P.parse_login(_login_lines(spark, sf)))


@query
def parse_login_corrupt(spark, sf):
    return P.corrupt_rows(P.parse_login(_login_lines(spark, sf))).withColumnRenamed("_line", "line")


@query
def user_aggregate(spark, sf):
    """User aggregate function: count and sum of cents per sensor."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("s"))
    made = lambda n, s: F.struct(n.cast("bigint").alias("n"), s.cast("bigint").alias("s"))
    r = _readings(spark, sf).select("event_id", "id", "temp_cents")
    a = U.keyed_aggregate(r, "id", F.col("temp_cents"), zero, lambda acc, v: made(acc["n"] + 1, acc["s"] + v),
                          lambda x, y: made(x["n"] + y["n"], x["s"] + y["s"]), order=["event_id"])
    return a.select("id", F.col("result.n").alias("cnt"), F.col("result.s").alias("sum_cents"))


@query
def user_reduce(spark, sf):
    """User reduce function: the later reading's time with the larger value."""
    r = _readings(spark, sf).select("event_id", "id", "timestamp", "temp_cents")
    value = F.struct("timestamp", "temp_cents")
    a = U.keyed_reduce(r, "id", ["event_id"], value, lambda x, y: F.struct(
        y["timestamp"].alias("timestamp"), F.greatest(x["temp_cents"], y["temp_cents"]).alias("temp_cents")))
    return a.select("id", "result.timestamp", "result.temp_cents")


@query
def stamp_records(spark, sf):
    return TX.stamp_records(_sensor_lines(spark, sf), now_ms=1700000000000)


@query
def parse_access_log(spark, sf):
    return P.valid_rows(P.parse_access_log(
        A.access_log_lines(_events(spark, sf), A.table(spark, sf, "pages"))))


@query
def static_filter(spark, sf):
    return TX.drop_static_assets(parse_access_log(spark, sf), "url").select("event_id", "url")


@query
def field_lengths(spark, sf):
    return TX.field_lengths(A.documents(spark, sf), "text", ",")


@query
def tokenize_words(spark, sf):
    return TX.tokenize_words(A.documents(spark, sf), "text", with_position=True)


@query
def hot_items_report(spark, sf):
    return N.format_ranking(hot_items(spark, sf))


@query
def id_length(spark, sf):
    def lengths(pdf, ctx):
        return pdf.assign(len=pdf["id"].map(ctx, na_action="ignore").astype("Int32"))[["id", "event_id", "len"]]
    return U.map_partitions_with_setup(_sensor(spark, sf).select("id", "event_id"), lengths,
                                       "id string, event_id bigint, len int", setup=lambda: len, teardown=lambda ctx: None)


# --- lateness ----------------------------------------------------------------

LATE_SIZE, LATE_DELAY, LATE_ALLOWED = "1 hour", "10 minutes", "10 minutes"


def _late_marked(spark, sf):
    a = A.arrivals(_events(spark, sf)).withColumn("ts_ms", F.col("timestamp") * 1000)
    return LT.mark_late(a, "ts_ms", ["arrival", "event_id"], LATE_SIZE, LATE_DELAY, LATE_ALLOWED)


@query
def late_rows(spark, sf):
    return _late_marked(spark, sf).where("late").select("event_id", "timestamp", "arrival", "window_end")


PAGE_SIZE, PAGE_SLIDE, PAGE_DELAY, PAGE_LATENESS = "10 minutes", "5 seconds", "1 second", "1 minute"


def _late_visits(spark, sf, size, slide):
    """The log in a synthetic arrival order (up to 15 minutes behind), marked per range of open windows, and the
    GET visits of pages in it. All rows of the log move the watermark."""
    log = A.arrivals(_events(spark, sf), 900).withColumn("ts_ms", F.col("timestamp") * 1000)
    log = LT.mark_late_sliding(log.select("event_id", "event_type", "arrival", "ts_ms"), "ts_ms", ["arrival", "event_id"],
                               size, slide, PAGE_DELAY, PAGE_LATENESS)
    gets = A.visited_pages(log.where(A.method_of(F.col("event_type")) == "GET"), A.table(spark, sf, "pages"))
    return log, TX.drop_static_assets(gets, "url")


@query
def hot_pages_late(spark, sf):
    """Top 3 pages per sliding window after all corrections by late rows within the allowed lateness."""
    _, visits = _late_visits(spark, sf, PAGE_SIZE, PAGE_SLIDE)
    counts = LT.corrected_counts(visits, ["url"], PAGE_SIZE, PAGE_SLIDE)
    return N.top_n_per_group(counts, ["window_end"], [F.col("cnt").desc(), F.col("url").asc()], 3)


@query
def late_pages(spark, sf):
    """Side output of the hot pages: visits all of whose windows are purged."""
    _, visits = _late_visits(spark, sf, PAGE_SIZE, PAGE_SLIDE)
    return visits.where("late").select("event_id", "url", "ts_ms", "arrival")


FIRING_SLIDE = "1 minute"


@query
def hot_pages_firings(spark, sf):
    """Firing history: at which arrival a page's window fires first, and every count it emits again for a late row."""
    log, visits = _late_visits(spark, sf, PAGE_SIZE, FIRING_SLIDE)
    fired = LT.window_firings(log, visits, ["url"], "ts_ms", ["arrival", "event_id"], PAGE_SIZE, FIRING_SLIDE, PAGE_DELAY)
    return fired.fillna(-1, ["arrival", "event_id"])  # -1: fires at the end of the input


# --- changelog of a ranking, map state over time --------------------------------

@query
def hot_items_changelog(spark, sf):
    """Retract stream of the top 5 items by page views per sliding window, kept up at every view."""
    views = _views(spark, sf).select("event_id", "item_id", F.window("ts", "1 hour", "5 minutes").alias("w"))
    views = views.select("event_id", "item_id", F.unix_millis("w.end").alias("window_end"))
    return C.changelog_top_n(views, ["window_end"], "item_id", "event_id", 5)


@query
def daily_items_changelog(spark, sf):
    """Retract stream of the top 3 items by events per day."""
    seen = A.behaviour(_events(spark, sf)).select("event_id", "item_id", F.window("ts", "1 day").alias("w"))
    return C.changelog_top_n(seen.select("event_id", "item_id", F.unix_millis("w.end").alias("window_end")), ["window_end"], "item_id", "event_id", 3)


def _map_rows(spark, sf):
    """Events as operations on a user's map: a sign-up clears it, an error removes the last click, others put their value."""
    kind = F.col("event_type")
    return _events(spark, sf).select(
        "user_id", "event_id", F.when(kind == "signup", F.lit(None)).when(kind == "error", F.lit("click")).otherwise(kind).alias("map_key"),
        F.when(kind.isin("signup", "error"), F.lit(None)).otherwise(F.col("value")).alias("value"))


@query
def map_state_intervals(spark, sf):
    return R.map_state_intervals(_map_rows(spark, sf), "user_id", "map_key", "value", "event_id").fillna(-1, ["valid_to"])  # -1: stands at the end


@query
def map_state_sizes(spark, sf):
    return R.map_state_sizes(_map_rows(spark, sf), "user_id", "map_key", "value", "event_id")


@query
def history_text(spark, sf):
    """Each reading with the five before it of its sensor, as text."""
    return R.keyed_history(_readings(spark, sf).select("id", "event_id", "temp_cents"), "id", "event_id", "temp_cents", 5)


# --- file tables with bad records ------------------------------------------------

from eventlens.session import run_folder  # noqa: E402
from eventlens.sources import files as FI  # noqa: E402

CSV_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, note string"


def _csv_table(spark, sf) -> DataFrame:
    """The events written as CSV lines, some of them broken (too few fields, a word for a number), and read as a table."""
    import uuid
    e = F.col("event_id")
    note = F.concat(F.lit('"said ""'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"", twice"'))
    text = lambda *cs: F.concat_ws(",", *[c.cast("string") for c in cs])
    line = F.when(e % 17 == 0, text(e, F.col("user_id"))).when(e % 19 == 0, text(e, F.col("user_id"), F.col("event_type"), F.lit("soon"), F.lit("none"))).otherwise(
        text(e, F.col("user_id"), F.col("event_type"), F.col("value"), note))
    path = f"{run_folder(spark)}/csv-{uuid.uuid4().hex}"
    _events(spark, sf).select(line.alias("value")).write.text(path)
    return FI.read_table(spark, path, CSV_SCHEMA)


@query
def csv_table_rows(spark, sf):
    return FI.good_records(_csv_table(spark, sf))


@query
def csv_table_bad(spark, sf):
    return FI.bad_records(_csv_table(spark, sf)).select("event_id", "line")


@query
def text_lines(spark, sf):
    """Lines of text files, read back and parsed."""
    import uuid
    path = f"{run_folder(spark)}/lines-{uuid.uuid4().hex}"
    _sensor_lines(spark, sf).select("value").write.text(path)
    return P.valid_rows(P.parse_sensor(FI.read_lines(spark, path)))


# --- partitioning, event-time table ------------------------------------------------

@query
def partition_hash(spark, sf):
    """Rows of one sensor are in one partition."""
    p = PA.with_partition_id(PA.partition_by(_sensor(spark, sf), "hash", 4, key="id"))
    return p.groupBy("id").agg(F.count_distinct("part").alias("parts"), F.count(F.lit(1)).alias("cnt"))


@query
def partition_round_robin(spark, sf):
    """Partitions of equal size, but for one row from each partition of the input (within a hundredth)."""
    p = PA.with_partition_id(PA.partition_by(_sensor(spark, sf), "rebalance", 4)).groupBy("part").agg(F.count(F.lit(1)).alias("cnt"))
    spread = F.max("cnt") - F.min("cnt") <= 1 + 0.01 * F.sum("cnt")
    return p.agg(F.sum("cnt").cast("bigint").alias("total"), F.count(F.lit(1)).alias("parts"), spread.alias("balanced"))


@query
def partition_random(spark, sf):
    """Partitions of about equal size: within ten standard deviations of a random deal."""
    p = PA.with_partition_id(PA.partition_by(_sensor(spark, sf), "shuffle", 4)).groupBy("part").agg(F.count(F.lit(1)).alias("cnt"))
    near = F.max("cnt") - F.min("cnt") <= 20 * F.sqrt(F.sum("cnt") * 3 / 16)
    return p.agg(F.sum("cnt").cast("bigint").alias("total"), F.count(F.lit(1)).alias("parts"), near.alias("balanced"))


@query
def event_table(spark, sf):
    """The readings as a table with an event-time column, asked in SQL by that time."""
    TB.as_event_table(_readings(spark, sf), "event_readings", ["event_id", "id", "ts"])
    return spark.sql("SELECT date_format(ts, 'yyyy-MM-dd') AS day, count(*) AS cnt, count(DISTINCT id) AS ids FROM event_readings GROUP BY 1")


from eventlens.plans import streams  # noqa: E402, F401
