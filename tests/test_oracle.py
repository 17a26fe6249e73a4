"""Every registered query against its DuckDB oracle on the smallest tables,
once as planned and once with the split (skew) plan forced."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from eventlens.plans.adapters import TABLES
from eventlens.plans.catalog import REGISTRY
from eventlens.plans.oracle import SQL

SF = "/root/testdata/sf0.001"
SPLIT_SENSITIVE = ["rolling_sum", "rolling_max_by", "keyed_history", "global_sequence", "count_window_avg",
                   "changelog_stats", "jump_alarm", "login_fail_timer", "rising_alarm", "late_rows", "uv_running",
                   "hot_pages_late", "late_pages", "rolling_min_by",
                   "login_fail_pairs", "match_times3", "match_sequence", "hot_pages", "hot_items"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def table(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


def check(spark, con, name):
    got = table(E.queries()[name](spark, SF).toPandas())
    want = table(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    check(spark, con, name)


@pytest.mark.parametrize("name", SPLIT_SENSITIVE)
def test_split_plan_matches_oracle(spark, con, name, monkeypatch):
    """Split prefix plan, tiny fan-out blocks and a tiny fold chunk together."""
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "97")
    monkeypatch.setenv("EVENTLENS_FAN_BLOCK", "5")
    monkeypatch.setenv("EVENTLENS_FOLD_CHUNK", "3")
    check(spark, con, name)


def test_every_query_of_the_library_has_an_oracle():
    assert set(REGISTRY) - set(SQL) == set()
