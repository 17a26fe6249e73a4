"""Benchmark decontamination by spaced seeds with verified, substitution-tolerant overlaps.

Texts and benchmark items are taken as lower-cased words. An overlap is
``WINDOW`` words of a text against as many consecutive words of an item, place
by place, of which at most ``ERRORS`` differ. Two fixed masks of eight places
read six words each and ignore two: however up to two substitutions lie in 13
words, one of the masks fits somewhere on unchanged words (tests try every
case), so no overlap is missed. Seeds of texts and of items are joined by hash;
around every hit the words on both sides are compared in full.

With ``short_items`` (as ``op6_decontaminate`` and the pipeline ask), an item
shorter than the window matches whole: all its words in a row, unchanged. The
run is its own seed, beside the spaced ones; texts are read for runs of the
lengths that short items have, each run counted once a text.

Each seed carries the words around it, so neither side is joined back to its
text. Before the join, text seeds pass a bitmap of the items' seed hashes. It
has ``2**BITMAP`` bits at any size of the benchmark: a large benchmark fills
it, which lets more seeds through to the join and loses none. Equal seeds with
equal surroundings in several items count once, for the smallest item id.

Defined results: null or empty texts and items match nothing, nor do items
shorter than the window without ``short_items``; with it, an item of one word is
in every text with that word, and ``matched`` of a short item is its number of
words; a row counts by its own text even if ids repeat or are null; repeated
rows are flagged alike; other columns pass through; with an empty benchmark
nothing is contaminated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import combine, per_task, shielded, slices, small_batches, table, words

WINDOW, ERRORS = 13, 2
#: Fixed masks: 1 reads a word, 0 ignores it.
MASKS = ("11101011", "11001111")
SPAN = len(MASKS[0])
AROUND = WINDOW - SPAN
WIDTH = SPAN + 2 * AROUND
BITMAP = 26
_CHUNK = 1 << 15  # bits that Spark's bitmap aggregate holds together

SEEDS = "seed long, start int, around binary"


def _seeds(words_of_text: np.ndarray, mask: int) -> np.ndarray:
    n = words_of_text.size - SPAN + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    picks = [words_of_text[i:i + n] for i, c in enumerate(MASKS[mask]) if c == "1"]
    return combine([*picks, np.full(n, mask + 1, np.uint64)])


def _runs(words_of_text: np.ndarray, length: int) -> np.ndarray:
    n = words_of_text.size - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    return combine([*(words_of_text[i:i + n] for i in range(length)), np.full(n, len(MASKS) + length, np.uint64)])


def _emit(id_cols: list[str], keep, lengths: list[int] | None):
    """mapInArrow function: (id columns, text) to seeds that ``keep`` lets through.

    Runs are taken of the given lengths; with None, of a text shorter than the window (an item) as a whole.
    """
    def seeds(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), lower=True)
                rows, seed, start, around = [], [], [], []
                for i in range(part.num_rows):
                    own = w.of(i) | np.uint64(1)  # never 0, which marks places outside the text
                    for length in lengths if lengths is not None else [own.size] if 0 < own.size < WINDOW else []:
                        h = _runs(own, length)
                        at = keep(h)
                        at = at[np.unique(h[at], return_index=True)[1]]
                        if at.size:
                            rows.append(np.full(at.size, i))
                            seed.append(h[at])
                            start.append(at)
                            around.extend(own[j:j + length].tobytes() for j in at.tolist())
                    if own.size < WINDOW:
                        continue
                    padded = np.concatenate([np.zeros(AROUND, np.uint64), own, np.zeros(AROUND, np.uint64)])
                    for mask in range(len(MASKS)):
                        h = _seeds(own, mask)
                        at = keep(h)
                        if at.size:
                            rows.append(np.full(at.size, i))
                            seed.append(h[at])
                            start.append(at)
                            around.extend(padded[j:j + WIDTH].tobytes() for j in at.tolist())
                if rows:
                    take = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c).take(take) for c in id_cols), pa.array(np.concatenate(seed).view(np.int64)),
                         pa.array(np.concatenate(start).astype(np.int32)), pa.array(around, pa.binary())], names=[*id_cols, "seed", "start", "around"])
    return seeds


def _bitmap(seeds: DataFrame) -> tuple[np.ndarray, list[int]]:
    """Bits of the seeds' upper hash places, and the lengths of short items; at most about 2**BITMAP / 8 bytes reach the driver."""
    place = F.shiftrightunsigned("seed", 64 - BITMAP) + 1
    # Runs carry their own words only: bit n for a run of n words.
    run = F.expr(f"CASE WHEN octet_length(item_around) < {8 * WIDTH} THEN shiftleft(1, CAST(octet_length(item_around) / 8 AS INT)) ELSE 0 END")
    chunks = (seeds.groupBy(F.bitmap_bucket_number(place).alias("k"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"), F.bit_or(run).alias("runs")).collect())
    out = np.zeros((1 << BITMAP) // 8, np.uint8)
    for r in chunks:
        at = (r.k - 1) * (_CHUNK // 8)
        out[at:at + _CHUNK // 8] = np.frombuffer(r.bits, np.uint8)
    return out, [n for n in range(1, WINDOW) if any(r.runs >> n & 1 for r in chunks)]


def _verify(batches):
    """Hits to overlaps: the best window over the seed, if it has few enough substitutions, or a whole short item."""
    for b in batches:
        if not b.num_rows:
            continue
        a, c = (np.frombuffer(b"".join(v.ljust(8 * WIDTH, b"\0") for v in b.column(k).to_pylist()), np.uint64).reshape(-1, WIDTH) for k in ("around", "item_around"))
        inside = np.cumsum(np.pad((a != 0) & (c != 0), ((0, 0), (1, 0))), axis=1)
        equal = np.cumsum(np.pad((a == c) & (a != 0), ((0, 0), (1, 0))), axis=1)
        whole = (inside[:, WINDOW:] - inside[:, :-WINDOW]) == WINDOW
        matched = np.where(whole, equal[:, WINDOW:] - equal[:, :-WINDOW], 0)
        best = matched.argmax(axis=1)
        most = matched.max(axis=1)
        # A short item has fewer words than a window, so no window is inside it.
        own = (c != 0).sum(axis=1)
        short = (own < WINDOW) & (a == c).all(axis=1)
        first = b.column("start").to_numpy().astype(np.int64) + np.where(short, 0, best - AROUND)
        most = np.where(short, own, most)
        at = np.flatnonzero(short | (most >= WINDOW - ERRORS))
        take = pa.array(at)
        yield pa.RecordBatch.from_arrays(
            [b.column("id").take(take), b.column("text_hash").take(take), b.column("item_id").take(take),
             pa.array(first[at]), pa.array(most[at].astype(np.int64))],
            names=["id", "text_hash", "item_id", "first_word", "matched"])


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
             item_text: str = "text", short_items: bool = False) -> DataFrame:
    """Per contaminated row: ``id``, ``text_hash`` and one overlap: ``item_id`` (the smallest), ``first_word`` (its first place) and ``matched``."""
    spark = docs.sparkSession
    small_batches(spark)
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    items = (benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
             .mapInArrow(per_task(_emit(["item_id"], lambda h: np.arange(h.size), None if short_items else [])), f"item_id {kinds[1]}, {SEEDS}")
             .groupBy("seed", F.col("around").alias("item_around")).agg(F.min("item_id").alias("item_id")))
    places, lengths = _bitmap(items)
    bits = spark.sparkContext.broadcast(places)

    def in_bitmap(h: np.ndarray) -> np.ndarray:
        place = h >> np.uint64(64 - BITMAP)
        return np.flatnonzero(bits.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    seeds = rows.mapInArrow(per_task(_emit(["id", "text_hash"], in_bitmap, lengths)), f"id {kinds[0]}, text_hash long, {SEEDS}")
    # By shuffle, so that finding seeds and comparing words are stages, and Python workers, of their own.
    found = (seeds.join(items.hint("merge"), "seed").select("id", "text_hash", "item_id", "start", "around", "item_around")
             .mapInArrow(per_task(_verify), f"id {kinds[0]}, text_hash long, item_id {kinds[1]}, first_word long, matched long"))
    # One overlap a row, whole: of the smallest item, the first place, the best match there.
    best = F.min(F.struct("item_id", "first_word", (-F.col("matched")).alias("missed")))
    return found.groupBy("id", "text_hash").agg(best.alias("o")).select("id", "text_hash", "o.item_id", "o.first_word", (-F.col("o.missed")).alias("matched"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", short_items: bool = False) -> DataFrame:
    """Rows of ``docs`` without any overlap."""
    found = overlaps(docs, benchmark, id_col, text, short_items=short_items).select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
    docs, back = shielded(docs, {"_text_hash", "_id", "_hash"})
    rows = docs.withColumn("_text_hash", F.xxhash64(text))
    return rows.join(found, rows[id_col].eqNullSafe(found["_id"]) & (rows["_text_hash"] == found["_hash"]), "left_anti").drop("_text_hash").withColumnsRenamed(back)


def op6_decontaminate(spark, sf_dir) -> DataFrame:
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)
    return found.select(F.col("id").alias("doc_id"), "item_id", "first_word", "matched")
