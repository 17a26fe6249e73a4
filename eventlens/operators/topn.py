"""Top-N per window and ranking reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.operators.windows import sliding_count


def top_n_per_group(df: DataFrame, group_cols, order_cols, n: int, rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..n per group (``row_number``; ties broken by ``order_cols``).

    Catalyst plans a partial group limit before the shuffle, so at most n
    rows per group and map task are exchanged even for a hot group.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def hot_items(behaviour: DataFrame, n: int = 5, size="1 hour", slide="5 minutes",
              strategy: str = "panes", item_col: str = "item_id", time_col: str = "ts") -> DataFrame:
    """Top-n items by page views per sliding window.

    Columns: item_id, window_end (ms), cnt, rn (1 = most viewed; ties → smaller id).
    """
    views = behaviour.where(F.col("behavior") == "pv").select(item_col, time_col)
    counts = sliding_count(views, time_col, size, slide, keys=[item_col], strategy=strategy)
    return top_n_per_group(counts, ["window_end"], [F.col("cnt").desc(), F.col(item_col).asc()], n)


def hot_items_sql(spark: SparkSession, behaviour: DataFrame, n: int = 5, size: str = "1 hour",
                  slide: str = "5 minutes", view: str = "data_table") -> DataFrame:
    """The same ranking written as SQL over a temp view (sliding window + ROW_NUMBER)."""
    behaviour.select("item_id", "behavior", "ts").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT item_id, window_end, cnt, rn FROM (
          SELECT item_id, window_end, cnt,
                 ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rn
          FROM (
            SELECT item_id, unix_millis(window.end) AS window_end, count(item_id) AS cnt
            FROM {view}
            WHERE behavior = 'pv'
            GROUP BY item_id, window(ts, '{size}', '{slide}')
          )
        ) WHERE rn <= {int(n)}
    """)


def hot_pages(log: DataFrame, n: int = 3, size="10 minutes", slide="5 seconds",
              strategy: str = "panes", exts=None) -> DataFrame:
    """Top-n URLs of GET requests per sliding window, static assets excluded.

    ``log`` is a parsed access log (``url``, ``method``, ``ts``).
    """
    from eventlens.functions.text import drop_static_assets
    gets = drop_static_assets(log.where(F.col("method") == "GET"), "url", exts).select("url", "ts")
    counts = sliding_count(gets, "ts", size, slide, keys=["url"], strategy=strategy)
    return top_n_per_group(counts, ["window_end"], [F.col("cnt").desc(), F.col("url").asc()], n)


def format_ranking(top: DataFrame, key_col: str = "item_id", count_col: str = "cnt",
                   end_col: str = "window_end", rank_col: str = "rn") -> DataFrame:
    """One text report per window: a header line, then ``NO i: key=… count=…``."""
    line = F.format_string("NO %d: %s=%s count=%d", F.col(rank_col), F.lit(key_col),
                           F.col(key_col).cast("string"), F.col(count_col))
    g = top.groupBy(end_col).agg(F.sort_array(F.collect_list(F.struct(F.col(rank_col), line.alias("l")))).alias("_ls"))
    header = F.concat(F.lit("window end: "),
                      F.date_format(F.timestamp_millis(F.col(end_col)), "yyyy-MM-dd HH:mm:ss.SSS"))
    return g.select(end_col, F.concat_ws("\n", header, F.array_join(F.transform("_ls", lambda x: x["l"]), "\n"))
                    .alias("report"))
