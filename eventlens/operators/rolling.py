"""Keyed rolling aggregates: one output row per input row, in arrival order.

Associative running aggregates go through the two-phase prefix operator
(``prefix.running_aggregates``) so a hot key is spread over range buckets.
Bounded-frame forms (count windows, bounded history) are expressed as a
sliding window over the per-key element index: each row is copied to the
``size`` index-windows it belongs to and grouped by (key, index-window),
so no key is processed as one sequential partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.text import tokenize_words
from eventlens.operators.sequence import BLK, local_fan_out
from eventlens.operators.prefix import BUCKET, Prefix, bucket_count, rows_per_bucket_default, running_aggregates, with_range_bucket


def exact(value: Column) -> Column:
    """A numeric value as DECIMAL with eight places, whose sums do not depend on
    the order: exact up to 30 digits before the point. NaN, infinities and larger values are NULL."""
    return value.try_cast("decimal(38,8)")


def beyond(value: Column) -> Column:
    """The finite doubles that ``exact`` cannot hold (10^30 and more), NULL for all others."""
    v = value.cast("double")
    return F.when(exact(value).isNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), v)


def exact_sum(total: Column, rest: Column) -> Column:
    """Sum as DOUBLE of an ``exact`` sum and the ``beyond`` sum of the same values."""
    return F.when(total.isNull() & rest.isNull(), F.lit(None)).otherwise(F.coalesce(total.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0)))


def avg_half_up(total: Column, n: Column, rest: Column | None = None) -> Column:
    """Exact average of ``n`` values with the ``exact`` sum ``total``, rounded
    half-up to four places, as DOUBLE; NULL for no values. Whole part and rest are
    divided apart, so no intermediate decimal is rounded. Averages of 10^13 and more, which a
    DOUBLE does not hold to four places, and those with values ``beyond`` (their sum is ``rest``), are plain quotients."""
    count = n.cast("decimal(19,0)")
    over = F.pmod(total, count)
    whole = F.call_function("div", total - over, count)
    places = F.call_function("div", over * F.lit(20_000) + count, count * F.lit(2))
    out = F.when(F.abs(total.cast("double")) < n * F.lit(1e13), (whole.cast("double") * 10_000 + places) / 10_000).otherwise(total.cast("double") / n)
    if rest is not None:
        out = F.when(rest.isNotNull(), exact_sum(total, rest) / n).otherwise(out)
    return F.when(n > 0, out)


def word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Final count per word: word, cnt (map-side combined)."""
    words = tokenize_words(docs.select(text_col), text_col)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def rolling_sum(docs: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """Running count of each word in arrival order (document, then position).

    A token's count is a prefix count of its word over (document, position). Whole texts are dealt by ranges of
    documents that hold about ``rows_per_bucket_default()`` tokens, and a range is tokenized and numbered in one
    task; only each range's counts of words are exchanged, never the tokens.
    """
    docs = docs.select(doc_col, text_col)
    spaces = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit(" "), F.lit("")))
    n, tokens = docs.agg(F.count(F.lit(1)), F.sum(spaces + 1)).first()  # a text's tokens are at most its spaces and one
    docs = with_range_bucket(docs, [doc_col], max(rows_per_bucket_default() * n // max(tokens or 0, 1), 1))

    def words(d):  # a token is never NULL
        return tokenize_words(d, text_col, with_position=True).withColumn("word", F.coalesce("word", F.lit("")))

    buckets = bucket_count(docs)
    dealt = words(docs.repartitionById(buckets, F.col(BUCKET))) if buckets > 1 else None
    r = running_aggregates(words(docs), ["word"], [doc_col, "pos"], {"cnt": Prefix("count")}, dealt=dealt)
    return r.select(doc_col, "pos", "word", "cnt")


def rolling_count(df: DataFrame, key: str, arrival: str, name: str = "cnt") -> DataFrame:
    """Running count per key (keyed value state defaulting to 0, +1 per row)."""
    return running_aggregates(df, [key], [arrival], {name: Prefix("count")})


def rolling_min_by(df: DataFrame, key: str, arrival: str, value: str, carry=()) -> DataFrame:
    """Per row: the row holding the smallest ``value`` so far (earliest on ties);
    columns as in ``rolling_max_by``, prefixed ``min_``. NULL values hold no minimum."""
    st = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col(arrival).alias("a"),
                                                   *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]))
    r = running_aggregates(df.withColumn("_st", st), [key], [arrival], {"_best": Prefix("min", "_st")})
    return r.select(*df.columns, F.col("_best.a").alias(f"min_{arrival}"),
                    *[F.col(f"_best.c{i}").alias(f"min_{c}") for i, c in enumerate(carry)], F.col("_best.v").alias(f"min_{value}"))


def rolling_max_by(df: DataFrame, key: str, arrival: str, value: str, carry=()) -> DataFrame:
    """Per row: the row holding the largest ``value`` so far (earliest on ties).

    Adds max_<arrival>, plus ``value`` and ``carry`` columns of that row
    (prefixed ``max_``).
    """
    st = F.struct(F.col(value).alias("v"), (-F.col(arrival)).alias("neg_a"),
                  *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    d = df.withColumn("_st", st)
    r = running_aggregates(d, [key], [arrival], {"_best": Prefix("max", "_st")})
    return r.select(*[c for c in df.columns],
                    (-F.col("_best.neg_a")).alias(f"max_{arrival}"),
                    *[F.col(f"_best.c{i}").alias(f"max_{c}") for i, c in enumerate(carry)],
                    F.col("_best.v").alias(f"max_{value}"))


def rolling_latest_max(df: DataFrame, key: str, arrival: str, value: str) -> DataFrame:
    """Reduce (first id, current timestamp, max value so far): the current row
    with ``value`` replaced by its running maximum."""
    r = running_aggregates(df, [key], [arrival], {"_m": Prefix("max", value)})
    return r.withColumn(value, F.col("_m")).drop("_m")


def global_sequence(df: DataFrame, arrival: str, name: str = "seq") -> DataFrame:
    """Global running count in arrival order, without a single-partition window:
    counts per arrival bucket, prefix over buckets, local row number."""
    return running_aggregates(df, [], [arrival], {name: Prefix("count")})


def _indexed(df: DataFrame, key: str, arrival: str) -> DataFrame:
    return rolling_count(df, key, arrival, "_idx")


def count_window(df: DataFrame, key: str, arrival: str, value: str, size: int = 10, slide: int = 2) -> DataFrame:
    """Count window per key: fires at every ``slide``-th element of a key over
    its last ≤ ``size`` elements, emitting the average of any numeric ``value``
    (of those that are not NULL).

    Element i (1-based per key) belongs to the windows firing at j ∈ [i, i+size-1]
    with j % slide == 0; a window exists once its j-th element arrived.
    Columns: key, n (firing element index), event of that element, cnt, avg.
    """
    idx = _indexed(df, key, arrival)
    fires = F.filter(F.sequence(F.col("_idx"), F.col("_idx") + F.lit(size - 1)),
                     lambda j: F.pmod(j, F.lit(slide)) == 0)
    ex = local_fan_out(idx.select(key, arrival, "_idx", exact(F.col(value)).alias("_v"), beyond(F.col(value)).alias("_b")), [key],
                       F.transform(fires, lambda j: F.struct(j.alias("_t"))))
    g = ex.groupBy(key, BLK, F.col("_e._t").alias("n")).agg(
        F.max("_idx").alias("_last"),
        F.max_by(F.col(arrival), F.col("_idx")).alias(arrival),
        F.count(F.lit(1)).alias("cnt"),
        F.sum("_v").alias("_s"), (F.count("_v") + F.count("_b")).alias("_k"), F.sum("_b").alias("_r"))
    return g.where(F.col("_last") == F.col("n")).select(
        key, F.col("n").cast("bigint").alias("n"), arrival, "cnt",
        avg_half_up(F.col("_s"), F.col("_k"), F.col("_r")).alias("avg_temp"))


def keyed_list(df: DataFrame, key: str, arrival: str, item: str) -> DataFrame:
    """The key's whole list state, uncut and linear: one row per item with its
    1-based ``position``. A row's history is the key's rows of lower position."""
    return _indexed(df.select(key, arrival, F.col(item).alias("item")), key, arrival).select(
        key, arrival, F.col("_idx").cast("bigint").alias("position"), "item")


def keyed_history(df: DataFrame, key: str, arrival: str, item: str, max_len: int = 5) -> DataFrame:
    """Per row: the previous ≤ ``max_len`` items of its key, oldest first, as text.

    Each row is copied to its own index and the next ``max_len`` indexes of
    its key, then grouped by (key, index): bounded work per row, no
    per-key sequential pass.
    """
    idx = _indexed(df, key, arrival)
    targets = F.transform(F.sequence(F.col("_idx"), F.col("_idx") + F.lit(max_len)), lambda t: F.struct(t.alias("_t")))
    ex = local_fan_out(idx.select(key, arrival, "_idx", F.col(item).cast("string").alias("_it")), [key], targets)
    ex = ex.withColumn("_t", F.col("_e._t"))
    g = ex.groupBy(key, BLK, "_t").agg(
        F.max(F.when(F.col("_idx") == F.col("_t"), F.col(arrival))).alias(arrival),
        F.sort_array(F.collect_list(F.when(F.col("_idx") < F.col("_t"),
                                           F.struct("_idx", "_it")))).alias("_h"))
    return g.where(F.col(arrival).isNotNull()).select(
        key, arrival, F.array_join(F.transform("_h", lambda s: s["_it"]), ",").alias("history"))


def latest_value_map(df: DataFrame, key: str, map_key: str, value: str, arrival: str, removes: bool = False) -> DataFrame:
    """Keyed map state, last write wins: one row per (key, map key) with the
    latest value and the arrival that wrote it. With ``removes`` a NULL value
    removes its map key, and a row of NULL map key clears the key's map."""
    g = df.groupBy(key, map_key).agg(F.max(F.struct(F.col(arrival), F.col(value))).alias("_l"))
    if removes:
        cleared = g.where(F.col(map_key).isNull()).select(key, F.col("_l").getField(arrival).alias("_cleared"))
        g = g.where(F.col(map_key).isNotNull() & F.col("_l").getField(value).isNotNull()).join(cleared, key, "left")
        g = g.where(F.col("_cleared").isNull() | (F.col("_l").getField(arrival) > F.col("_cleared")))
    return g.select(key, map_key, F.col("_l").getField(value).alias(value),
                    F.col("_l").getField(arrival).alias(arrival))



def map_state_intervals(df: DataFrame, key: str, map_key: str, value: str, arrival: str) -> DataFrame:
    """Keyed map state over time: one row per entry of the map while it holds one value.

    A row puts ``value`` under its map key; a NULL value removes the map key, a NULL map key clears the key's
    map. Columns: key, map_key, value, ``valid_from`` (the arrival that put it) and ``valid_to`` (the
    arrival that replaced, removed or cleared it; NULL while it stands). The state after any arrival is the rows with
    valid_from ≤ arrival < valid_to. An entry's end is the smaller of two running minima from the end:
    the next row of its map key and the next clear of its key.
    """
    d = df.select(key, map_key, value, arrival, (-F.col(arrival)).alias("_back"))
    clears = F.when(F.col(map_key).isNull(), F.col(arrival))
    d = running_aggregates(with_range_bucket(d, ["_back"]), [key], ["_back"], {"_clear": Prefix("min", clears, inclusive=False)})
    d = running_aggregates(d, [key, map_key], ["_back"], {"_next": Prefix("min", arrival, inclusive=False)})
    puts = d.where(F.col(map_key).isNotNull() & F.col(value).isNotNull())
    return puts.select(key, map_key, value, F.col(arrival).alias("valid_from"), F.least("_next", "_clear").alias("valid_to"))


def map_state_sizes(df: DataFrame, key: str, map_key: str, value: str, arrival: str) -> DataFrame:
    """Number of entries in the key's map after every row: entries begun minus entries ended, as a running sum."""
    held = map_state_intervals(df, key, map_key, value, arrival)
    turns = held.select(key, F.explode(F.array(F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("d")),
                                               F.struct(F.col("valid_to").alias("at"), F.lit(-1).alias("d")))).alias("_t"))
    turns = turns.where("_t.at IS NOT NULL").select(key, F.col("_t.at").alias(arrival), F.col("_t.d").alias("_d"), F.lit(0).alias("_row"))
    rows = df.select(key, arrival, F.lit(0).alias("_d"), F.lit(1).alias("_row")).unionByName(turns)
    at = rows.groupBy(key, arrival).agg(F.sum("_d").alias("_d"))
    return running_aggregates(at, [key], [arrival], {"entries": Prefix("sum", "_d")}).select(key, arrival, "entries")
