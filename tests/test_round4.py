"""Round 4: window layouts and word counts whose tasks stay small as the tables grow."""

from __future__ import annotations

import collections
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from eventlens.operators import lateness as LT
from eventlens.operators import rolling as R
from eventlens.operators import topn as N
from eventlens.operators import windows as W

T0 = dt.datetime(2024, 1, 1, 0, 0, 1, tzinfo=dt.timezone.utc)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def visits(spark, n=600):
    """A hot page, pages in bursts, a page without a name, and visits without a time."""
    rows = [(None if i % 97 == 0 else f"/{0 if i % 3 else i % 41}", "GET", None if i % 89 == 0 else T0 + dt.timedelta(seconds=i // 7 * 5 + i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "url string, method string, ts timestamp")


def tasks_of(p):
    return [int(x) for x in re.findall(r"rangepartitioning\(.*?, (\d+)\)", p)]


@pytest.mark.parametrize("slide", [5, 7, 60, 90])
def test_laid_out_windows_are_dealt_by_their_number(spark, monkeypatch, slide):
    df, size = visits(spark), 60
    want = collections.Counter()
    for r in df.where("ts IS NOT NULL").collect():
        t = int(r.ts.replace(tzinfo=dt.timezone.utc).timestamp())
        for s in range(t // slide * slide, t - size, -slide):
            want[r.url, (s + size) * 1000] += 1
    for rows in (100, 10**6):
        monkeypatch.setenv("EVENTLENS_LAID_OUT_ROWS", str(rows))
        out = W.sliding_count(df, "ts", f"{size} seconds", f"{slide} seconds", ["url"])
        got = out.collect()
        assert len(got) == len(want) and {(r.url, r.window_end): r.cnt for r in got} == want
        p = plan(out)
        if rows == 10**6:
            assert not tasks_of(p)
        else:
            # As many tasks as the rows need, and no table of laid-out rows in any of them.
            panes = df.where("ts IS NOT NULL").select("url", F.floor(F.unix_millis("ts") / 1000)).distinct().count()
            few = rows // max(size // slide, 1)
            assert tasks_of(p) and tasks_of(p)[0] >= panes // 15 // few and "HashAggregate" not in p.split("Generate explode")[0]


def test_hot_pages_dealt_by_block_and_page(spark, monkeypatch):
    df = visits(spark).where("url IS NOT NULL AND ts IS NOT NULL")
    want = {tuple(r) for r in N.hot_pages(df, strategy="direct").select("url", "window_end", "cnt", "rn").collect()}
    monkeypatch.setenv("EVENTLENS_LAID_OUT_ROWS", "2400")
    top = N.hot_pages(df)
    assert {tuple(r) for r in top.select("url", "window_end", "cnt", "rn").collect()} == want
    assert tasks_of(plan(top))[0] > 5 and "WindowGroupLimit" in plan(top)


def test_corrected_counts_are_dealt_by_their_number(spark, monkeypatch):
    size, slide = 60, 5
    rows = []
    for i in range(800):
        t = i // 3 * 5
        first, last = (t - size) // slide * slide + slide + size, t // slide * slide + size
        still = first + i % 15 * slide  # some rows find windows purged, some all of them
        rows.append((None if i % 97 == 0 else f"/{0 if i % 4 else i % 23}", still * 1000, None if i % 89 == 0 else last * 1000, still > last))
    marked = spark.createDataFrame(rows, "url string, open_from long, open_to long, late boolean")
    want = collections.Counter((u, e) for u, lo, hi, late in rows if hi is not None and not late for e in range(lo, hi + 1, slide * 1000))
    for some, least in ((240, 25), (10**6, 0)):
        monkeypatch.setenv("EVENTLENS_LAID_OUT_ROWS", str(some))
        out = LT.corrected_counts(marked, ["url"], f"{size} seconds", f"{slide} seconds")
        got = out.collect()
        assert len(got) == len(want) and {(r.url, r.window_end): r.cnt for r in got} == want
        assert tasks_of(plan(out))[0] >= least if least else not tasks_of(plan(out))
        assert "HashAggregate" not in plan(out)


def test_tokens_are_numbered_where_their_texts_lie(spark, monkeypatch):
    texts = [(i // 2 if i % 13 else None, None if i % 17 == 0 else " ".join(f"w{(i * j) % 7}" for j in range(i % 9)) + " the" * (i % 3) + "  " * (i % 2)) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "1000000")
    seen = collections.Counter(tuple(r) for r in R.rolling_sum(docs).collect())
    ends = collections.Counter()
    for (_, _, word, cnt), k in seen.items():
        ends[word] += k
    assert all(max(c for _, _, w, c in seen if w == word) == n for word, n in ends.items())
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "60")
    out = R.rolling_sum(docs)
    at, rest = plan(out).splitlines(), ("HashAggregate", "Window", "Scan", "Generate")
    exchanges = [i for i, x in enumerate(at) if "Exchange " in x]
    below = [next(w for x in at[i + 1:] for w in rest if w in x) for i in exchanges]
    # Texts and totals travel; tokens are made after that and neither written nor sent.
    assert below and "Generate" not in below and any("Generate" in x for x in at)
    assert collections.Counter((r.word, r.cnt) for r in out.collect()) == collections.Counter((w, c) for (_, _, w, c), k in seen.items() for _ in range(k))
    tokens = collections.Counter((r.doc_id, r.pos, r.word) for r in out.collect())
    assert tokens == sum((collections.Counter({(d, p, w): k}) for (d, p, w, _), k in seen.items()), collections.Counter())
