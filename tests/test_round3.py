"""Ranking changelog, firing history, map state over time: against step-by-step models."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventlens.operators import changelog as C
from eventlens.operators import lateness as LT
from eventlens.operators import rolling as R


@pytest.fixture(params=[None, "11"], ids=["one bucket", "many buckets"])
def buckets(request, monkeypatch):
    if request.param:
        monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", request.param)


def rank_changes(rows, n):
    counts, reached, shown, out = defaultdict(Counter), {}, {}, []
    for at, (g, k) in enumerate(rows):
        counts[g][k] += 1
        reached[g, k] = at
        top = sorted(counts[g], key=lambda x: (-counts[g][x], reached[g, x]))[:n]
        now = {(x, counts[g][x], i + 1) for i, x in enumerate(top)}
        before = shown.get(g, set())
        out += [(g, at, "-", *r) for r in before - now] + [(g, at, "+", *r) for r in now - before]
        shown[g] = now
    return sorted(out, key=repr)


@pytest.mark.parametrize("keys,n,seed", [(4, 2, 1), (7, 3, 2), (3, 5, 3), (30, 1, 4)])
def test_ranking_changelog_is_the_difference_of_rankings(spark, buckets, keys, n, seed):
    r = random.Random(seed)
    rows = [(r.choice(["g", "h", None]) if r.random() < 0.5 else "g", r.choice([None, *map(str, range(1, keys))])) for _ in range(220)]
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], "g string, k string, at long")
    got = sorted((tuple(x) for x in C.changelog_top_n(df, ["g"], "k", "at", n).collect()), key=repr)
    assert got == rank_changes(rows, n)


def test_changelog_of_no_rows(spark):
    empty = spark.createDataFrame([], "g string, k string, at long")
    assert C.changelog_top_n(empty, ["g"], "k", "at").collect() == []


def firings_of(rows, size, slide, delay, lateness):
    """rows: (key, ts) in arrival order; watermark before a row: largest earlier time minus delay. A None key is not counted."""
    counts, fired, number, out, top = Counter(), set(), Counter(), [], None
    for at, (key, ts) in enumerate(rows):
        wm = None if top is None else top - delay
        last = ts // slide * slide + size
        for end in range(last, ts, -slide):
            if key is None or (wm is not None and end - 1 + lateness <= wm):
                continue
            counts[key, end] += 1
            if wm is not None and end - 1 <= wm:
                number[key, end] += 1
                fired.add((key, end))
                out.append((key, end, at, counts[key, end], number[key, end]))
        top = ts if top is None else max(top, ts)
        for key_end in [x for x in counts if x not in fired and x[1] - 1 <= top - delay]:
            fired.add(key_end)
            number[key_end] += 1
            out.append((*key_end, at, counts[key_end], number[key_end]))
    out += [(*x, None, c, 1) for x, c in counts.items() if x not in fired]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_firing_history_against_a_step_by_step_model(spark, buckets, seed):
    r = random.Random(seed)
    rows, t = [], 100_000
    for _ in range(160):
        t += r.choice([0, 200, 900, 900, 2500, 30_000 if r.random() < 0.05 else 0])
        rows.append((r.choice(["a", "b", None]), t - r.choice([0, 0, 0, 1500, 4000, 9000, 25_000])))
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], "k string, ts long, at long")
    marked = LT.mark_late_sliding(df, "ts", ["at"], "6 seconds", "2 seconds", "1 second", "5 seconds")
    got = LT.window_firings(marked, marked.where("k IS NOT NULL"), ["k"], "ts", ["at"], "6 seconds", "2 seconds", "1 second").collect()
    want = firings_of(rows, 6000, 2000, 1000, 5000)
    assert sorted((tuple(x) for x in got), key=repr) == want and any(w[4] > 1 for w in want) and any(w[2] is None for w in want)
    final = {(x.k, x.window_end): x.cnt for x in LT.corrected_counts(marked.where("k IS NOT NULL"), ["k"], "6 seconds", "2 seconds").collect()}
    assert final == {w[:2]: max(v[3] for v in want if v[:2] == w[:2]) for w in want}


def test_first_reaching_is_an_as_of_lookup(spark, buckets):
    r = random.Random(9)
    marks = [(r.randint(0, 500), i) for i in range(60)]
    asked = sorted({r.randint(-10, 520) for _ in range(80)})
    rows = spark.createDataFrame(marks, "v long, id long")
    got = LT.first_reaching(spark.createDataFrame([(a,) for a in asked], "at long"), "at", rows, "v", ["v", "id"]).collect()
    assert {x.at: (x.v, x.id) for x in got} == {a: min([m for m in marks if m[0] >= a], default=(None, None)) for a in asked}


def test_map_state_over_time(spark, buckets):
    r = random.Random(4)
    rows = [(r.choice(["u", "v"]), r.choice([None, "a", "b", "c", "c"]), r.choice([None, 1, 2, 3]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, m string, v long, at long")
    held = R.map_state_intervals(df, "k", "m", "v", "at").collect()
    sizes = {(x.k, x["at"]): x.entries for x in R.map_state_sizes(df, "k", "m", "v", "at").collect()}
    state = defaultdict(dict)
    for k, m, v, at in rows:
        if m is None:
            state[k].clear()
        elif v is None:
            state[k].pop(m, None)
        else:
            state[k][m] = v
        assert {x.m: x.v for x in held if x.k == k and x.valid_from <= at and (x.valid_to is None or at < x.valid_to)} == state[k]
        assert sizes[k, at] == len(state[k])


def test_key_less_prefix_is_dealt_over_tasks(spark):
    rows = spark.range(20_000).select(F.col("id").alias("at"))
    seq = R.global_sequence(rows, "at")
    assert "/eventlens-local" in seq._jdf.queryExecution().executedPlan().toString() and seq.where("seq != at + 1").count() == 0


def test_sums_and_averages_of_large_values(spark):
    """No value leaves a sum: long integers are exact, doubles of any size count."""
    from eventlens.operators import tables as TB
    from eventlens.operators import windows as W
    longs = [123456789012345678, 123456789012345679, -5, None, 999999999999999999]
    df = spark.createDataFrame([("s", v, i, float(i)) for i, v in enumerate(longs)], "id string, temperature long, at long, x double").withColumn("ts", F.timestamp_seconds("at"))
    known = [v for v in longs if v is not None]
    for f in (TB.sensor_stats(df), TB.sensor_stats_sql(spark, df)):
        r = f.first()
        assert r.cnt == 5 and r.avg_temp == pytest.approx(sum(known) / len(known), rel=1e-15)
    w = R.count_window(df, "id", "at", "temperature", size=5, slide=1).orderBy("n").collect()
    assert [x.avg_temp for x in w] == pytest.approx([sum(known[:k]) / k for k in (1, 2, 3, 3, 4)], rel=1e-15)
    kept = W.window_sum_keep_first(df, "ts", "1 hour", ["id"], "temperature", "at").first()
    assert kept.temperature == sum(known)
    for values, total in (([1e20, 2.5, None, float("nan")], 1e20 + 2.5), ([1e300, 1e300, 1.0], 2e300), ([1e31, 0.25], 1e31), ([0.1] * 10, 1.0)):
        d = spark.createDataFrame([("s", v, i) for i, v in enumerate(values)], "id string, temperature double, at long").withColumn("ts", F.timestamp_seconds("at"))
        n = sum(v is not None and v == v for v in values)
        assert TB.sensor_stats(d).first().avg_temp == pytest.approx(total / n, rel=1e-12)
        assert TB.sensor_stats_sql(spark, d).first().avg_temp == pytest.approx(total / n, rel=1e-12)
        assert W.window_sum_keep_first(d, "ts", "1 hour", ["id"], "temperature", "at").first().temperature == pytest.approx(total, rel=1e-12)
        last = C.changelog_count_avg(d, "id", "at", "temperature").where("op = '+'").orderBy(F.desc("at")).first()
        assert last.cnt == len(values) and last.avg_temp == pytest.approx(total / n, rel=1e-12)


def test_lines_are_parsed_once(spark):
    import __spark_entry__ as E
    p = E.queries()["parse_behavior_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("get_json_object") <= 2 and p.count("split(") == 1


def test_tokens_are_not_gathered(spark):
    import __spark_entry__ as E
    p = E.queries()["rolling_sum"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in p


def test_inputs_are_dealt_only_when_asked(spark):
    from eventlens.plans import adapters as A
    plain = A.documents(spark, "/root/testdata/sf0.001")
    assert "RoundRobin" not in plain._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(6)" in A.documents(spark, "/root/testdata/sf0.001", 6)._jdf.queryExecution().executedPlan().toString()
