"""Independent DuckDB SQL for each registered query (the correctness oracle).

Tables are the driver's parquet views. The adapters are restated in SQL
(not generated from the Spark code) so both sides are independent.
"""

from __future__ import annotations

BEH = """beh AS (
  SELECT event_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
         epoch_us(ts) // 1000000 AS t
  FROM events)"""

READ = """rd AS (
  SELECT event_id, 'sensor_' || CAST(user_id % 12 AS VARCHAR) AS id,
         epoch_us(ts) // 1000000 AS timestamp, value AS temperature,
         CAST(round(value * 100) AS BIGINT) AS temp_cents
  FROM events)"""

LOGIN = """lg AS (
  SELECT event_id, user_id,
         CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS login_state,
         epoch_us(ts) // 1000000 AS timestamp
  FROM events)"""

PAGES = """np AS (SELECT count(*) AS n FROM pages),
pg AS (
  SELECT no, CASE WHEN no % 11 = 0 THEN url || '.' || ['css', 'js', 'png', 'ico'][(no // 11) % 4 + 1] ELSE url END AS url
  FROM (SELECT url, row_number() OVER (ORDER BY page_id) - 1 AS no FROM pages))"""

LOG = f"""{PAGES},
acc AS (
  SELECT e.event_id, p.url,
         CASE WHEN e.event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
         epoch_us(e.ts) // 1000000 AS t
  FROM events e, np JOIN pg p ON p.no = e.event_id % np.n)"""

SQL: dict[str, str] = {}

SQL["hot_items"] = f"""
WITH {BEH},
w AS (SELECT item_id, ((t // 300) + 1 + k) * 300000 AS window_end
      FROM beh, range(12) r(k) WHERE behavior = 'pv'),
c AS (SELECT item_id, window_end, count(*) AS cnt FROM w GROUP BY item_id, window_end),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rn FROM c)
SELECT item_id, window_end, cnt, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 5
"""
SQL["hot_items_sql"] = SQL["hot_items"]

SQL["hot_pages"] = f"""
WITH {LOG},
g AS (SELECT url, t FROM acc WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png|ico)$')),
w AS (SELECT url, ((t // 5) + 1 + k) * 5000 AS window_end FROM g, range(120) r(k)),
c AS (SELECT url, window_end, count(*) AS cnt FROM w GROUP BY url, window_end),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rn FROM c)
SELECT url, window_end, cnt, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 3
"""

SQL["page_views"] = f"""
WITH {BEH}
SELECT (t // 3600 + 1) * 3600000 AS window_end, count(*) AS cnt
FROM beh WHERE behavior = 'pv' GROUP BY 1
"""
SQL["page_views_salted"] = SQL["page_views"]

SQL["unique_visitors"] = f"""
WITH {BEH}
SELECT (t // 3600 + 1) * 3600000 AS window_end, count(DISTINCT user_id) AS uv
FROM beh WHERE behavior = 'pv' GROUP BY 1
"""

SQL["uv_approx"] = SQL["unique_visitors"].replace("AS uv\n", "AS uv, TRUE AS within\n")

UVH = """list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                 lambda a, b: (a * 25 + b) % 536870912, CAST(0 AS BIGINT))"""

SQL["uv_bitmap"] = f"""
WITH {BEH}
SELECT (t // 3600 + 1) * 3600000 AS window_end, count(DISTINCT {UVH}) AS uv
FROM beh WHERE behavior = 'pv' GROUP BY 1
"""

SQL["uv_running"] = f"""
WITH {BEH},
f AS (SELECT (t // 3600 + 1) * 3600000 AS window_end, {UVH} AS h, min(event_id) AS event_id
      FROM beh WHERE behavior = 'pv' GROUP BY 1, 2)
SELECT window_end, event_id, row_number() OVER (PARTITION BY window_end ORDER BY event_id, h) AS uv FROM f
"""

SQL["tumbling_min_by"] = f"""
WITH {READ},
r AS (SELECT *, (timestamp // 3600 + 1) * 3600000 AS window_end,
             row_number() OVER (PARTITION BY id, timestamp // 3600 ORDER BY temperature, event_id) AS k
      FROM rd)
SELECT id, window_end, event_id, timestamp, temperature FROM r WHERE k = 1
"""

SQL["tumbling_sum_keep_first"] = f"""
WITH {READ},
r AS (SELECT *, (timestamp // 3600 + 1) * 3600000 AS window_end,
             row_number() OVER (PARTITION BY id, timestamp // 3600 ORDER BY event_id) AS k,
             sum(temp_cents) OVER (PARTITION BY id, timestamp // 3600) AS s
      FROM rd)
SELECT id, window_end, event_id, timestamp, CAST(s AS BIGINT) / 100.0 AS temperature FROM r WHERE k = 1
"""

SQL["sliding_count"] = f"""
WITH {READ},
w AS (SELECT id, ((timestamp // 600) + 1 + k) * 600000 AS window_end FROM rd, range(6) r(k))
SELECT id, window_end, count(*) AS cnt FROM w GROUP BY id, window_end
"""

WORDS = """tok AS (
  SELECT doc_id,
         CASE WHEN text = '' THEN ['']
              WHEN rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[])
              ELSE string_split(rtrim(text, ' '), ' ') END AS arr
  FROM documents),
words AS (SELECT doc_id, unnest(range(len(arr))) AS pos, unnest(arr) AS word FROM tok)"""


def avg4(s: str, n: str) -> str:
    """Half-up average to 4 places of a cents sum, in decimals."""
    return f"CAST(floor(CAST(({s}) AS DECIMAL(28, 0)) * 100 / ({n}) + 0.5) / 10000.0 AS DOUBLE)"


SQL["word_count"] = f"""
WITH {WORDS}
SELECT word, count(*) AS cnt FROM words GROUP BY word
"""

SQL["rolling_sum"] = f"""
WITH {WORDS}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, word,
       row_number() OVER (PARTITION BY word ORDER BY doc_id, pos) AS cnt
FROM words
"""

SQL["rolling_count"] = f"""
WITH {READ}
SELECT id, event_id, row_number() OVER (PARTITION BY id ORDER BY event_id) AS cnt FROM rd
"""

SQL["rolling_max_by"] = f"""
WITH {READ},
p AS (SELECT *, max(temperature) OVER (PARTITION BY id ORDER BY event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max FROM rd),
q AS (SELECT *, max(CASE WHEN prev_max IS NULL OR temperature > prev_max THEN event_id END)
                 OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rec
      FROM p)
SELECT q.id, q.event_id, q.timestamp, q.temperature, q.rec AS max_event_id,
       b.timestamp AS max_timestamp, b.temperature AS max_temperature
FROM q JOIN rd b ON b.event_id = q.rec
"""

SQL["rolling_latest_max"] = f"""
WITH {READ}
SELECT id, event_id, timestamp,
       max(temperature) OVER (PARTITION BY id ORDER BY event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temperature
FROM rd
"""

SQL["keyed_history"] = f"""
WITH {READ}
SELECT id, event_id, row_number() OVER (PARTITION BY id ORDER BY event_id) AS position, event_id AS item
FROM rd
"""

SQL["latest_value_map"] = """
SELECT user_id, event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id
FROM events GROUP BY user_id, event_type
"""

SQL["global_sequence"] = """
SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS seq FROM events
"""

SQL["count_window_avg"] = f"""
WITH {READ},
w AS (SELECT id, event_id,
             row_number() OVER (PARTITION BY id ORDER BY event_id) AS n,
             count(*) OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS cnt,
             sum(temp_cents) OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s
      FROM rd)
SELECT id, n, event_id, cnt, {avg4('s', 'cnt')} AS avg_temp FROM w WHERE n % 2 = 0
"""

SQL["changelog_stats"] = f"""
WITH {READ},
r AS (SELECT id, event_id, temp_cents,
             row_number() OVER (PARTITION BY id ORDER BY event_id) AS n,
             sum(temp_cents) OVER (PARTITION BY id ORDER BY event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
      FROM rd)
SELECT id, event_id, '+' AS op, n AS cnt, {avg4('s', 'n')} AS avg_temp, 1 AS seq FROM r
UNION ALL
SELECT id, event_id, '-' AS op, n - 1 AS cnt, {avg4('s - temp_cents', 'n - 1')} AS avg_temp, 0 AS seq
FROM r WHERE n > 1
"""

SQL["jump_alarm"] = f"""
WITH {READ},
p AS (SELECT id, event_id, temperature,
             lag(temperature) OVER (PARTITION BY id ORDER BY event_id) AS last_temperature FROM rd)
SELECT id, event_id, last_temperature, temperature FROM p
WHERE last_temperature IS NOT NULL AND abs(temperature - last_temperature) >= 10.0
"""

SQL["login_fail_pairs"] = f"""
WITH {LOGIN},
p AS (SELECT user_id, login_state, timestamp,
             lag(login_state) OVER w AS ps, lag(timestamp) OVER w AS pt
      FROM lg WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, event_id))
SELECT user_id, pt AS first_fail_time, timestamp AS last_fail_time, 'login fail' AS warning_msg
FROM p WHERE login_state = 'fail' AND ps = 'fail' AND timestamp - pt <= 3600
"""

SQL["match_times3"] = f"""
WITH {LOGIN},
p AS (SELECT user_id, login_state, timestamp,
             lead(login_state, 1) OVER w AS s1, lead(login_state, 2) OVER w AS s2,
             lead(timestamp, 2) OVER w AS t2
      FROM lg WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, event_id))
SELECT user_id, timestamp AS first_fail_time, t2 AS last_fail_time, 'login fail 3 times' AS warning_msg
FROM p WHERE login_state = 'fail' AND s1 = 'fail' AND s2 = 'fail' AND t2 - timestamp < 86400
"""
SQL["match_sequence"] = SQL["match_times3"]

SQL["login_fail_timer"] = f"""
WITH RECURSIVE {LOGIN},
r AS (SELECT user_id, login_state = 'fail' AS fail, timestamp AS t,
             row_number() OVER (PARTITION BY user_id ORDER BY timestamp, event_id) AS i,
             count(*) OVER (PARTITION BY user_id) AS m
      FROM lg),
s(user_id, i, m, f, l, n, of, ol, on_) AS (
  SELECT user_id, i, m, CASE WHEN fail THEN t END, CASE WHEN fail THEN t END,
         CASE WHEN fail THEN 1 ELSE 0 END, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS INTEGER)
  FROM r WHERE i = 1
  UNION ALL
  SELECT r.user_id, r.i, r.m,
         CASE WHEN NOT r.fail THEN NULL
              WHEN s.f IS NOT NULL AND r.t <= s.f + 86400 THEN s.f ELSE r.t END,
         CASE WHEN NOT r.fail THEN NULL ELSE r.t END,
         CASE WHEN NOT r.fail THEN 0
              WHEN s.f IS NOT NULL AND r.t <= s.f + 86400 THEN s.n + 1 ELSE 1 END,
         CASE WHEN s.f IS NOT NULL AND r.t > s.f + 86400 THEN s.f END,
         CASE WHEN s.f IS NOT NULL AND r.t > s.f + 86400 THEN s.l END,
         CASE WHEN s.f IS NOT NULL AND r.t > s.f + 86400 THEN s.n END
  FROM s JOIN r ON r.user_id = s.user_id AND r.i = s.i + 1),
alarms AS (
  SELECT user_id, of AS f, ol AS l, on_ AS n FROM s WHERE of IS NOT NULL
  UNION ALL
  SELECT user_id, f, l, n FROM s WHERE i = m AND f IS NOT NULL)
SELECT user_id, f AS first_fail_time, l AS last_fail_time, 'login fail ' || CAST(n AS VARCHAR) AS warning_msg
FROM alarms WHERE n >= 2
"""

SQL["rising_alarm"] = f"""
WITH RECURSIVE {READ},
r AS (SELECT id, timestamp AS t,
             CASE WHEN row_number() OVER w = 1 THEN true ELSE coalesce(temperature > lag(temperature) OVER w, false) END AS rise,
             row_number() OVER w AS i, count(*) OVER (PARTITION BY id) AS m
      FROM rd WINDOW w AS (PARTITION BY id ORDER BY timestamp, event_id)),
s(id, i, m, a, fired) AS (
  SELECT id, i, m, CASE WHEN rise THEN t END, CAST(NULL AS BIGINT) FROM r WHERE i = 1
  UNION ALL
  SELECT r.id, r.i, r.m,
         CASE WHEN s.a IS NOT NULL AND r.t > s.a + 3600 THEN (CASE WHEN r.rise THEN r.t END)
              WHEN s.a IS NULL THEN (CASE WHEN r.rise THEN r.t END)
              WHEN r.rise THEN s.a
              ELSE NULL END,
         CASE WHEN s.a IS NOT NULL AND r.t > s.a + 3600 THEN s.a END
  FROM s JOIN r ON r.id = s.id AND r.i = s.i + 1),
alarms AS (SELECT id, fired AS a FROM s WHERE fired IS NOT NULL
           UNION ALL SELECT id, a FROM s WHERE i = m AND a IS NOT NULL)
SELECT id, a AS armed_ts, a + 3600 AS fired_ts,
       'sensor ' || id || ' rose continuously for 3600s' AS warning_msg
FROM alarms
"""

SENS = "id, event_id, timestamp, temperature"

SQL["split_high"] = f"WITH {READ} SELECT {SENS} FROM rd WHERE temperature > 30"
SQL["split_low"] = f"WITH {READ} SELECT {SENS} FROM rd WHERE temperature <= 30"
SQL["side_output_low"] = SQL["split_low"]
SQL["co_map"] = f"""
WITH {READ}
SELECT id, event_id, temperature, CASE WHEN temperature > 30 THEN 'high warning' ELSE 'normal' END AS status
FROM rd
"""
SQL["union_all"] = f"""
WITH {READ}
SELECT {SENS} FROM rd WHERE temperature > 30
UNION ALL SELECT {SENS} FROM rd WHERE temperature <= 30
UNION ALL SELECT {SENS} FROM rd
"""
SQL["partition_custom"] = f"""
WITH {READ}
SELECT CAST(timestamp % 4 AS INTEGER) AS part, count(*) AS cnt FROM rd GROUP BY 1
"""
SQL["sensor_stats"] = f"""
WITH {READ}
SELECT id, count(id) AS cnt, {avg4('sum(temp_cents)', 'count(id)')} AS avg_temp FROM rd GROUP BY id
"""
SQL["sensor_stats_sql"] = SQL["sensor_stats"]
SQL["table_select"] = f"WITH {READ} SELECT id, temperature FROM rd WHERE id = 'sensor_1'"
SQL["prefix_filter"] = f"WITH {READ} SELECT id, event_id FROM rd WHERE starts_with(id, 'sensor_1')"
SQL["parse_sensor_lines"] = f"WITH {READ} SELECT event_id, {SENS.replace('event_id, ', '')} FROM rd"
SQL["stamp_records"] = f"""
WITH {READ}
SELECT event_id, '1700000000000,' || id || ',' || CAST(timestamp AS VARCHAR) || ',' || CAST(temperature AS VARCHAR) AS value
FROM rd
"""
SQL["parse_access_log"] = f"""
WITH {LOG}, u AS (SELECT event_id, user_id FROM events)
SELECT acc.event_id,
       '10.' || CAST((u.user_id // 65536) % 256 AS VARCHAR) || '.' || CAST((u.user_id // 256) % 256 AS VARCHAR)
             || '.' || CAST(u.user_id % 256 AS VARCHAR) AS ip,
       '-' AS user_id, acc.t * 1000 AS timestamp, acc.method, acc.url
FROM acc JOIN u ON u.event_id = acc.event_id
"""
SQL["static_filter"] = f"""
WITH {LOG}
SELECT event_id, url FROM acc WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$')
"""
SQL["field_lengths"] = """
WITH f AS (
  SELECT doc_id,
         CASE WHEN text = '' THEN ['']
              WHEN rtrim(text, ',') = '' THEN CAST([] AS VARCHAR[])
              ELSE string_split(rtrim(text, ','), ',') END AS arr
  FROM documents)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(length(x) AS INTEGER) AS len
FROM (SELECT doc_id, unnest(range(len(arr))) AS pos, unnest(arr) AS x FROM f)
"""
SQL["tokenize_words"] = f"""
WITH {WORDS}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, word FROM words
"""
SQL["hot_items_report"] = f"""
WITH h AS ({SQL['hot_items']})
SELECT window_end,
       'window end: ' || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S.%g') || chr(10) ||
       string_agg('NO ' || CAST(rn AS VARCHAR) || ': item_id=' || CAST(item_id AS VARCHAR)
                  || ' count=' || CAST(cnt AS VARCHAR), chr(10) ORDER BY rn) AS report
FROM h GROUP BY window_end
"""
SQL["id_length"] = f"WITH {READ} SELECT id, event_id, CAST(length(id) AS INTEGER) AS len FROM rd"

ARR = """ar AS (
  SELECT event_id, event_type, epoch_us(ts) // 1000000 AS timestamp,
         epoch_us(ts) // 1000000 + (event_id * 7919) % 5400 AS arrival
  FROM events),
m AS (
  SELECT *, (timestamp // 3600 + 1) * 3600000 AS window_end,
         max(timestamp * 1000) OVER (ORDER BY arrival, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000 AS wm
  FROM ar)"""

SQL["late_rows"] = f"""
WITH {ARR}
SELECT event_id, timestamp, arrival, window_end FROM m WHERE window_end - 1 + 600000 <= wm
"""
PAGES_LATE = f"""{PAGES},
ar AS (
  SELECT event_id, event_type, epoch_us(ts) // 1000000 * 1000 AS ts_ms, epoch_us(ts) // 1000000 + (event_id * 7919) % 900 AS arrival FROM events),
m AS (
  SELECT *, max(ts_ms) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000 AS wm
  FROM ar),
v AS (
  SELECT m.*, p.url FROM m, np JOIN pg p ON p.no = m.event_id % np.n
  WHERE m.event_type NOT IN ('purchase', 'signup') AND NOT regexp_matches(p.url, '\\.(css|js|png|ico)$')),
w AS (
  SELECT event_id, url, ts_ms, arrival, (ts_ms // 5000 + 1 + k) * 5000 AS window_end,
         coalesce((ts_ms // 5000 + 1 + k) * 5000 - 1 + 60000 <= wm, false) AS purged
  FROM v, range(120) r(k))"""

SQL["hot_pages_late"] = f"""
WITH {PAGES_LATE},
c AS (SELECT url, window_end, count(*) AS cnt FROM w WHERE NOT purged GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rn FROM c)
SELECT url, window_end, cnt, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 3
"""
SQL["late_pages"] = f"""
WITH {PAGES_LATE}
SELECT event_id, any_value(url) AS url, any_value(ts_ms) AS ts_ms, any_value(arrival) AS arrival
FROM w GROUP BY event_id HAVING bool_and(purged)
"""

SQL["hot_pages_firings"] = f"""
WITH {PAGES_LATE.replace("5000", "60000").replace("range(120)", "range(10)").replace("AS purged", "AS purged, coalesce((ts_ms // 60000 + 1 + k) * 60000 - 1 <= wm, false) AS fired")},
clock AS (SELECT top, arg_min(arrival, (arrival, event_id)) AS arrival, arg_min(event_id, (arrival, event_id)) AS event_id
  FROM (SELECT *, max(ts_ms) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS top FROM ar) GROUP BY top),
base AS (SELECT url, window_end, count(*) AS cnt FROM w WHERE NOT purged AND NOT fired GROUP BY ALL),
first AS (
  SELECT b.url, b.window_end, coalesce(c.arrival, -1) AS arrival, coalesce(c.event_id, -1) AS event_id, b.cnt, 1 AS firing
  FROM (SELECT *, window_end - 1 + 1000 AS need FROM base) b ASOF LEFT JOIN clock c ON b.need <= c.top)
SELECT * FROM first
UNION ALL
SELECT l.url, l.window_end, l.arrival, l.event_id,
  coalesce(b.cnt, 0) + row_number() OVER g AS cnt, CASE WHEN b.cnt IS NULL THEN 0 ELSE 1 END + row_number() OVER g AS firing
FROM (SELECT * FROM w WHERE fired AND NOT purged) l LEFT JOIN base b ON b.url = l.url AND b.window_end = l.window_end
WINDOW g AS (PARTITION BY l.url, l.window_end ORDER BY l.arrival, l.event_id)
"""


def _rank_changes(rows: str, n: int) -> str:
    """Snapshots of the ranking after every row, and the difference of each to the one before."""
    return f"""
WITH {BEH},
ev AS ({rows}),
seq AS (SELECT *, lag(event_id) OVER (PARTITION BY window_end ORDER BY event_id) AS prev FROM ev),
held AS (
  SELECT a.window_end, a.event_id AS upto, b.item_id, count(*) AS cnt, max(b.event_id) AS last
  FROM ev a JOIN ev b ON a.window_end = b.window_end AND b.event_id <= a.event_id GROUP BY ALL),
top AS (
  SELECT * EXCLUDE (last) FROM (SELECT *, row_number() OVER (PARTITION BY window_end, upto ORDER BY cnt DESC, last) AS rn FROM held) WHERE rn <= {n}),
pairs AS (SELECT s.window_end, s.event_id, t.upto = s.event_id AS now, t.item_id, t.cnt, t.rn
  FROM seq s JOIN top t ON t.window_end = s.window_end AND (t.upto = s.event_id OR t.upto = s.prev)),
sides AS (SELECT window_end, event_id, item_id, cnt, rn, bool_or(now) AS after, bool_or(NOT now) AS before FROM pairs GROUP BY ALL)
SELECT window_end, event_id, CASE WHEN after THEN '+' ELSE '-' END AS op, item_id, cnt, CAST(rn AS INTEGER) AS rn FROM sides WHERE after <> before
"""


SQL["hot_items_changelog"] = _rank_changes(
    "SELECT event_id, item_id, ((t // 300) + 1 + k) * 300000 AS window_end FROM beh, range(12) r(k) WHERE behavior = 'pv'", 5)
SQL["daily_items_changelog"] = _rank_changes("SELECT event_id, item_id, ((t // 86400) + 1) * 86400000 AS window_end FROM beh", 3)

MAP = """ops AS (
  SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'click' ELSE event_type END AS map_key,
    CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE value END AS value FROM events),
held AS (
  SELECT p.user_id, p.map_key, p.value, p.event_id AS valid_from, min(q.event_id) AS valid_to
  FROM ops p LEFT JOIN ops q ON q.user_id = p.user_id AND q.event_id > p.event_id AND (q.map_key IS NULL OR q.map_key = p.map_key)
  WHERE p.map_key IS NOT NULL AND p.value IS NOT NULL GROUP BY ALL)"""

SQL["map_state_intervals"] = f"WITH {MAP} SELECT * REPLACE (coalesce(valid_to, -1) AS valid_to) FROM held"
SQL["map_state_sizes"] = f"""
WITH {MAP}
SELECT o.user_id, o.event_id, count(h.user_id) AS entries
FROM ops o LEFT JOIN held h ON h.user_id = o.user_id AND h.valid_from <= o.event_id AND (h.valid_to IS NULL OR h.valid_to > o.event_id)
GROUP BY o.user_id, o.event_id
"""
SQL["history_text"] = f"""
WITH {READ}
SELECT id, event_id, coalesce(string_agg(before, ',' ORDER BY prev) FILTER (before IS NOT NULL), '') AS history FROM (
  SELECT a.id, a.event_id, unnest(list_concat([NULL], list(a.p) OVER w5)).t AS before, unnest(list_concat([NULL], list(a.p) OVER w5)).e AS prev
  FROM (SELECT *, {{'e': event_id, 't': CAST(temp_cents AS VARCHAR)}} AS p FROM rd) a
  WINDOW w5 AS (PARTITION BY id ORDER BY event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) GROUP BY id, event_id
"""

SQL["rolling_min_by"] = f"""
WITH {READ},
p AS (SELECT *, min(temperature) OVER (PARTITION BY id ORDER BY event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_min FROM rd),
q AS (SELECT *, max(CASE WHEN prev_min IS NULL OR temperature < prev_min THEN event_id END)
                 OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rec
      FROM p)
SELECT q.id, q.event_id, q.timestamp, q.temperature, q.rec AS min_event_id,
       b.timestamp AS min_timestamp, b.temperature AS min_temperature
FROM q JOIN rd b ON b.event_id = q.rec
"""
SQL["user_aggregate"] = f"""
WITH {READ} SELECT id, count(*) AS cnt, CAST(sum(temp_cents) AS BIGINT) AS sum_cents FROM rd GROUP BY id
"""
SQL["user_reduce"] = f"""
WITH {READ} SELECT id, arg_max(timestamp, event_id) AS timestamp, max(temp_cents) AS temp_cents FROM rd GROUP BY id
"""

IP = """'10.' || CAST((user_id // 65536) % 256 AS VARCHAR) || '.' || CAST((user_id // 256) % 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)"""
GOOD, SHORT = "event_id % 17 <> 0 AND event_id % 19 <> 0", "event_id % 17 = 0"
SQL["parse_behavior_lines"] = f"""
WITH {BEH}
SELECT event_id, user_id, item_id, CAST(item_id % 10 AS INTEGER) AS category_id, behavior, t AS timestamp FROM beh WHERE {GOOD}
"""
SQL["parse_behavior_corrupt"] = f"""
WITH {BEH}
SELECT CASE WHEN {SHORT} THEN concat_ws(',', item_id, item_id % 10, behavior, t)
            ELSE concat_ws(',', user_id, item_id, item_id % 10, behavior, 'soon') END AS line
FROM beh WHERE NOT ({GOOD})
"""
SQL["parse_login_lines"] = f"""
WITH {LOGIN}
SELECT event_id, user_id, {IP} AS ip, login_state, timestamp FROM lg WHERE {GOOD}
"""
SQL["parse_login_corrupt"] = f"""
WITH {LOGIN}
SELECT CASE WHEN {SHORT} THEN concat_ws(',', {IP}, login_state, timestamp)
            ELSE concat_ws(',', user_id, {IP}, login_state, 'soon') END AS line
FROM lg WHERE NOT ({GOOD})
"""

CLOSED = "window_end <= (SELECT max(epoch_us(ts)) // 1000000 * 1000 FROM events WHERE event_type IN ('view', 'pv'))"
SQL["stream_page_views_salted"] = f"SELECT * FROM ({SQL['page_views']}) WHERE {CLOSED}"
SQL["stream_uv_bitmap"] = f"SELECT * FROM ({SQL['uv_bitmap']}) WHERE {CLOSED}"
SQL["stream_unique_visitors"] = f"SELECT * FROM ({SQL['unique_visitors']}) WHERE {CLOSED}"
SQL["stream_sliding_count"] = """
WITH w AS (SELECT event_type, ((epoch_us(ts) // 1000000 // 600) + 1 + k) * 600000 AS window_end FROM events, range(6) r(k))
SELECT event_type, window_end, count(*) AS cnt FROM w
WHERE window_end <= (SELECT max(epoch_us(ts)) // 1000000 * 1000 FROM events) GROUP BY event_type, window_end
"""
SQL["stream_sequence"] = "SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS seq FROM events"
SQL["stream_routes"] = f"""
WITH {READ} SELECT event_id, id, temperature, CASE WHEN temperature > 30 THEN 'high' ELSE 'low' END AS route FROM rd WHERE temperature IS NOT NULL
"""

# The record as the reader parses it: a line of too few fields is padded with NULLs, a field of the wrong type is NULL.
CSV = """rec AS (
  SELECT event_id, user_id, event_type, value, props, event_id % 17 = 0 AS short, event_id % 17 <> 0 AND event_id % 19 = 0 AS word FROM events)"""
SQL["csv_table_rows"] = f"WITH {CSV} SELECT event_id, user_id, event_type, value, 'said \"' || props || '\", twice' AS note FROM rec WHERE NOT short AND NOT word"
SQL["csv_table_bad"] = f"""
WITH {CSV} SELECT event_id, CASE WHEN short THEN event_id || ',' || user_id ELSE event_id || ',' || user_id || ',' || event_type || ',soon,none' END AS line
FROM rec WHERE short OR word
"""

SQL["text_lines"] = f"WITH {READ} SELECT id, timestamp, temperature FROM rd WHERE temperature IS NOT NULL"
SQL["partition_hash"] = f"WITH {READ} SELECT id, 1 AS parts, count(*) AS cnt FROM rd GROUP BY id"
SQL["partition_round_robin"] = "SELECT count(*) AS total, 4 AS parts, true AS balanced FROM events"
SQL["partition_random"] = SQL["partition_round_robin"]
SQL["event_table"] = f"""
WITH {READ} SELECT strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS day, count(*) AS cnt, count(DISTINCT id) AS ids FROM rd GROUP BY 1
"""
