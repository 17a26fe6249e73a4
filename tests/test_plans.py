"""Plan-shape checks for the scale properties the operators rely on."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from eventlens.operators import windows as W
from eventlens.operators.sequence import BLK, local_fan_out
from eventlens.plans import adapters as A

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_view_filter_and_pruning_reach_the_scan(spark):
    p = plan(E.queries()["hot_items"](spark, SF))
    assert "PushedFilters: [In(event_type" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in p


def test_top_n_uses_partial_group_limit(spark):
    p = plan(E.queries()["hot_items"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_pane_fan_out_is_not_shuffled(spark):
    ev = A.behaviour(spark.read.parquet(f"{SF}/events.parquet"))
    p = plan(W.sliding_count(ev, "ts", "1 hour", "5 minutes", ["item_id"]))
    # one exchange for pane counts, one for (key, window-end block); the
    # exploded rows are summed where they are made
    assert p.count("Exchange") == 2
    assert "REPARTITION_BY_COL" in p


def test_local_fan_out_needs_one_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("i"))
    items = F.array(*[F.struct((F.col("i") + F.lit(o)).alias("_t")) for o in range(4)])
    g = local_fan_out(df, ["k"], items).groupBy("k", BLK, F.col("_e._t").alias("t")).count()
    assert plan(g).count("Exchange") == 1


def test_keyed_split_plan_has_no_unpartitioned_window_over_rows(spark, monkeypatch):
    monkeypatch.setenv("EVENTLENS_ROWS_PER_BUCKET", "100")
    p = plan(E.queries()["rolling_count"](spark, SF))
    # no single-partition exchange at all, and both scans read the bucket table, not the input
    assert "SinglePartition" not in p
    assert "events.parquet" not in p and p.count("Location: InMemoryFileIndex") <= 2 and "/eventlens-local" in p
    assert "hashpartitioning(_kv0" in p or "hashpartitioning(id" in p
