"""Phrase collocations per language: Misra-Gries summaries find what is frequent, a second pass counts it.

A text's A-Z are lower-cased; it is split into pieces at ``.,;:!?`` and line
ends, and a piece into words at blanks and tabs. A phrase is two or three words
in a row of one piece. All statistics are per language.

First pass: every n-gram (one to three words) of every text is hashed; a part of
the hash names its partition, another its code there. A task sends, per
partition, its distinct codes with their counts. There they are merged into one
Misra-Gries summary: whenever it holds more codes than its capacity, the count
of the first code beyond it is taken from all, and codes without a rest go.
The capacity exceeds the partition's mass (its number of n-grams) divided by the
least count (``SLACK`` times, which lets fewer others through), so that less than the least count is ever
taken from a code, and every n-gram of at least that count survives. Summaries of parts merge
into one of the whole with the same bound. What may be frequent by its summary
sets a bit in a bitmap of fixed size, which is all that the driver gets or sends.

Second pass: tasks count the n-grams whose bit is set, by their text, and send the counts,
packed, to the same partitions, which add them up by text. A code that two n-grams share, or a bit,
only lets more through; what is below the least count goes here. So the result is exact.

Cuts, scores and the inclusion of phrases in longer ones are joins of the counted
n-grams. Scores are integer arithmetic in DECIMAL(38, 0): exact for up to 10^15
words a language.

Defined results: null text is empty; null language is ``und``, together with
rows that bear this name; repeated rows count each; equal scores go by count,
then by the phrase's bytes; very long texts are read whole; other columns, also
of clashing names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import _BASE, _LOWER, SLICE_BYTES, _power_tables, buffers, buffers_of, combine, mix, per_task, release, slices, small_batches, table, written

#: Longest phrase, in words.
LONGEST = 3
#: A summary's capacity, as multiples of mass divided by least count.
SLACK = 4
#: Codes a summary may hold, about (12 bytes each): more text makes more partitions.
SUMMARY = 2_000_000
#: Bits of the bitmap: 16 MB.
BITS = 1 << 27
#: N-grams that a task holds before it sends or adds them up, in the first and in the second pass.
HELD, HELD_TEXTS = 1 << 21, 1 << 20

_WORD, _BLANK, _END = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _END
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[0x09] = 0x20
#: Between a language and an n-gram in one text; neither holds it as a separator.
_AFTER_LANG = b"\n"


def _language(lang: str) -> Column:
    return F.coalesce(F.col(lang).cast("string"), F.lit("und"))


class Grams:
    """The n-grams of some texts (bytes, offsets, languages): hashes, first word and length in words."""

    def __init__(self, data: np.ndarray, off: np.ndarray, langs: np.ndarray):
        self.data = data
        n = data.size
        kind = _KIND[data]
        word = kind == _WORD
        edge = np.empty(n + 1, bool)
        edge[:] = False
        edge[off] = True
        before = np.empty(n, bool)
        before[:1], before[1:] = True, ~word[:-1]
        after = np.empty(n, bool)
        after[-1:], after[:-1] = True, ~word[1:]
        self.starts = np.flatnonzero(word & (before | edge[:-1]))
        self.ends = np.flatnonzero(word & (after | edge[1:])) + 1
        # Pieces are numbered by the separators and text borders before a word.
        breaks = np.zeros(n + 1, np.int64)
        np.cumsum((kind == _END) | edge[:-1], out=breaks[1:])
        piece = breaks[self.starts + 1] if n else np.empty(0, np.int64)
        up, down = _power_tables(n)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(_LOWER[data] * up[:n], out=total[1:])
        of_text = np.searchsorted(off, self.starts, side="right") - 1
        self.lang = langs[of_text]
        h = mix((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))
        tag = mix(self.lang.astype(np.uint64) + np.uint64(_BASE))
        hashes, first, size = [], [], []
        for k in range(1, LONGEST + 1):
            m = h.size - k + 1
            if m <= 0:
                break
            at = np.flatnonzero(piece[:m] == piece[k - 1:])
            hashes.append(combine([tag[at], *(h[at + i] for i in range(k))]))
            first.append(at)
            size.append(np.full(at.size, k, np.int8))
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.first = np.concatenate(first) if first else np.empty(0, np.int64)
        self.size = np.concatenate(size) if size else np.empty(0, np.int8)

    def texts(self, names: "Names", chosen: np.ndarray) -> pa.Array:
        """Language, line end and n-gram: words lower-cased, joined by one blank."""
        first, size = self.first[chosen], self.size[chosen].astype(np.int64)
        low = _FOLD[self.data].tobytes()
        lo, hi = self.starts[first], self.ends[first + size - 1]
        # Words are mostly one blank apart: then the n-gram is a piece of the folded text.
        spare = np.concatenate([[0], np.cumsum(self.starts[1:] - self.ends[:-1] - 1)]) if self.starts.size else np.zeros(1, np.int64)
        plain = spare[first + size - 1] == spare[first]
        out = [low[s:e] for s, e in zip(lo.tolist(), hi.tolist(), strict=True)]
        for i in np.flatnonzero(~plain).tolist():
            out[i] = b" ".join(x for x in out[i].split(b" ") if x)
        lang = self.lang[first]
        tags = {x: names.of[x].encode() + _AFTER_LANG for x in np.unique(lang).tolist()}
        if len(tags) == 1:
            tag = next(iter(tags.values()))
            return pa.array([tag + x for x in out], pa.large_binary())
        return pa.array([tags[k] + x for k, x in zip(lang.tolist(), out, strict=True)], pa.large_binary())


class Names:
    """Languages as numbers that are the same in every task: their own hashes."""

    def __init__(self):
        self.of: dict[int, str] = {}
        self.known: dict[str, int] = {}

    def numbers(self, langs: list[str]) -> np.ndarray:
        for name in set(langs) - self.known.keys():
            raw = np.frombuffer(name.encode() or b"\0", np.uint8).astype(np.uint64)
            h = int(combine([np.array([x], np.uint64) for x in raw])[0]) >> 1
            self.known[name], self.of[h] = h, name
        return np.array([self.known[x] for x in langs], np.int64)


def _grams(batches):
    """The n-grams of batches of (lang, text), about a megabyte of text at a time: a longer text is cut
    between pieces, which changes none of its n-grams."""
    names = Names()
    for batch in batches:
        for part in slices(batch, "text"):
            data, off = buffers(part.column("text"))
            langs = names.numbers(part.column("lang").to_pylist())
            if data.size < 2 * SLICE_BYTES:
                yield names, Grams(data, off, langs)
                continue
            ends = np.flatnonzero(_KIND[data] == _END)
            cuts = np.unique(np.concatenate([off, ends[np.searchsorted(ends, np.arange(SLICE_BYTES, data.size, SLICE_BYTES)).clip(max=max(ends.size - 1, 0))]
                                             if ends.size else off]))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                at = int(np.searchsorted(off, lo, side="right")) - 1
                yield names, Grams(data[lo:hi], np.array([0, hi - lo]), langs[at:at + 1])


def _merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with the sums of their counts."""
    if not codes.size:
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[heads], np.add.reduceat(counts, heads)


class Summary:
    """Misra-Gries summary of (code, count): a code's true count is at most its count here plus ``taken``."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.codes, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((codes, counts))
        self.held += codes.size
        if self.held > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        self.codes, self.counts = _merged(np.concatenate([self.codes, *(w[0] for w in self.waiting)]),
                                          np.concatenate([self.counts, *(w[1] for w in self.waiting)]))
        self.waiting, self.held = [], 0
        over = self.codes.size - self.capacity
        if over > 0:
            less = np.partition(self.counts, over - 1)[over - 1]  # the largest count beyond the capacity
            keep = self.counts > less
            self.codes, self.counts = self.codes[keep], self.counts[keep] - less
            self.taken += int(less)

    def survivors(self, least: int) -> np.ndarray:
        """Codes whose true count may be ``least`` or more."""
        self.settle()
        return self.codes[self.counts + self.taken >= least]


def _place(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition (from the upper half of a hash) and code (the lower half)."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64), hashes.astype(np.uint32)


def _bit(part: np.ndarray, codes: np.ndarray, parts: int) -> np.ndarray:
    """A code's bit: every partition has an equal stretch of the bitmap."""
    width = BITS // parts
    return part * width + (codes.astype(np.uint64) * np.uint64(width) >> np.uint64(32)).astype(np.int64)


def _spread(parts: int):
    """Texts to (partition, codes that occur once, other codes, their counts), and (partition, mass)."""
    def spread(batches):
        held, size = [], 0

        def sent():
            hashes, counts = _merged(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            part, codes = _place(hashes, parts)  # in the order of the hashes, so parts ascend
            cuts = np.searchsorted(part, np.arange(parts + 1))
            rows = []
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                c, k = codes[cuts[p]:cuts[p + 1]], counts[cuts[p]:cuts[p + 1]]
                more = k > 1
                rows.append((p, None, None, None, int(k.sum())))
                rows.append((p, c[~more].tobytes(), c[more].tobytes(), k[more].astype("<u4").tobytes(), 0))
                if len(rows) >= 64:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

        for _, g in _grams(batches):
            held.append(_merged(g.hashes, np.ones(g.hashes.size, np.int64)))
            size += held[-1][0].size
            if size > HELD:
                yield from sent()
                held, size = [], 0
        if held:
            yield from sent()
    return spread


_CODES = "part int, once binary, more binary, counts binary, mass long"


def _rows(rows) -> pa.RecordBatch:
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=["part", "once", "more", "counts", "mass"])


def _summarise(parts: int, least: int):
    """Rows of a partition, its masses first, to its stretch of the bitmap, packed."""
    def summarised(batches):
        width = BITS // parts
        part, mass, summary = None, 0, None

        def stretch():
            bits = np.zeros(-(-width // 8) * 8, np.uint8)
            codes = summary.survivors(least)
            bits[_bit(np.zeros(codes.size, np.int64), codes, parts)] = 1
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
                                              names=["part", "bits"])

        for b in batches:
            for i in range(b.num_rows):
                p, once, more, counts, m = (c[i].as_py() for c in b.columns)
                if p != part:
                    if summary is not None:
                        yield stretch()
                    part, mass, summary = p, 0, None
                mass += m
                if once is not None:
                    summary = summary or Summary(SLACK * mass // least + 1)
                    one, many = np.frombuffer(once, "<u4"), np.frombuffer(more, "<u4")
                    summary.add(np.concatenate([one, many]), np.concatenate([np.ones(one.size, np.int64), np.frombuffer(counts, "<u4").astype(np.int64)]))
        if summary is not None:
            yield stretch()
    return summarised


def _summed(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    """Counts by text."""
    return pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


_CODEC = "zstd"


def _packed(table: pa.Table) -> tuple[int, int, bytes]:
    """Rows, size and compressed bytes of lengths, counts and texts; in the order of the texts they take a third."""
    texts = pa.concat_arrays(table["gram"].chunks).cast(pa.large_binary()) if table.num_rows else pa.array([], pa.large_binary())
    data, off = buffers_of(texts)
    raw = np.diff(off).astype("<u4").tobytes() + table["n"].to_numpy().astype("<i8").tobytes() + data.tobytes()
    return table.num_rows, len(raw), pa.Codec(_CODEC).compress(raw, asbytes=True)


def _unpacked(rows: int, size: int, packed: bytes) -> pa.Table:
    raw = np.frombuffer(pa.Codec(_CODEC).decompress(packed, size), np.uint8)
    off = np.concatenate([[0], np.cumsum(raw[:4 * rows].view("<u4"), dtype=np.int64)])
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(raw[12 * rows:]))])
    return pa.table({"gram": texts, "n": raw[4 * rows:12 * rows].copy().view("<i8")})


def _count(bitmap, parts: int):
    """Texts to (partition, packed counts) of the n-grams whose bit is set; combined while they fit."""
    def counted(batches):
        bits, held, size = bitmap.value, [], 0

        def sent():
            table = _summed(held, ["part", "gram"]).sort_by([("part", "ascending"), ("gram", "ascending")])
            part = table["part"].to_numpy()
            heads = np.flatnonzero(np.diff(part, prepend=-1))
            for lo, hi in zip(heads.tolist(), np.append(heads[1:], part.size)[:heads.size].tolist(), strict=True):
                rows, size, packed = _packed(table.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([part[lo]], pa.int32()), pa.array([rows]), pa.array([size]), pa.array([packed], pa.binary())],
                                                 names=["part", "rows", "size", "counts"])

        for names, g in _grams(batches):
            part, codes = _place(g.hashes, parts)
            where = _bit(part, codes, parts)
            at = np.flatnonzero(bits[where >> 3] >> (where & 7).astype(np.uint8) & 1)
            _, first, n = np.unique(g.hashes[at], return_index=True, return_counts=True)
            chosen = at[first]
            held.append(pa.table({"part": part[chosen].astype(np.int32), "gram": g.texts(names, chosen), "n": n.astype(np.int64)}))
            size += chosen.size
            if size > HELD_TEXTS:
                held = [_summed(held, ["part", "gram"])]
                size = held[0].num_rows
                if size > HELD_TEXTS // 2:
                    yield from sent()
                    held, size = [], 0
        if held:
            yield from sent()
    return counted


def _add_up(least: int):
    """Packed counts of a partition, in a row, to the n-grams of at least the least count."""
    def added(batches):
        part, held, size = None, [], 0

        def done():
            table = _summed(held, ["gram"])
            table = table.filter(pc.greater_equal(table["n"], least))
            for b in table.select(["gram", "n"]).cast(pa.schema([("gram", pa.binary()), ("n", pa.int64())])).to_batches(1 << 16):
                yield b

        for b in batches:
            for p, rows, raw, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != part:
                    if held:
                        yield from done()
                    part, held, size = p, [], 0
                held.append(_unpacked(rows, raw, packed))
                size += held[-1].num_rows
                if size > HELD_TEXTS and len(held) > 1:
                    held = [_summed(held, ["gram"])]
                    size = held[0].num_rows // 2  # what is added up waits for as much again
        if held:
            yield from done()
    return added


def frequent_grams(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10) -> DataFrame:
    """(``lang``, ``phrase``, ``words``, ``n``): every n-gram of one to three words that occurs ``least`` times or more."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(_language(lang).alias("lang"), F.col(text).cast("string").alias("text"))
    n = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word and its blank take two bytes at least, and starts LONGEST n-grams at most.
    mass = n // 2 * LONGEST
    parts = max(math.ceil(SLACK * mass / least / SUMMARY), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = (rows.mapInArrow(per_task(_spread(parts)), _CODES)
             .repartition("part").sortWithinPartitions("part", F.col("once").isNotNull()))
    bitmap = np.zeros(BITS // 8 + 8, np.uint8)
    width = BITS // parts
    for r in dealt.mapInArrow(per_task(_summarise(parts, least)), "part int, bits binary").collect():
        # A stretch begins anywhere in a byte: its bits are moved there and added.
        own = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")
        lead = r.part * width % 8
        moved = np.packbits(np.concatenate([np.zeros(lead, np.uint8), own]), bitorder="little")
        at = r.part * width // 8
        bitmap[at:at + moved.size] |= moved[:bitmap.size - at]
    release()
    shared = spark.sparkContext.broadcast(bitmap)
    counted = rows.mapInArrow(per_task(_count(shared, parts)), "part int, rows long, size long, counts binary")
    added = counted.repartition("part").sortWithinPartitions("part").mapInArrow(per_task(_add_up(least)), "gram binary, n long")
    gram = F.decode("gram", "UTF-8")
    phrase = F.substring_index("gram", "\n", -1)
    return added.select(gram.alias("gram"), "n").select(
        F.expr("left(gram, length(gram) - length(substring_index(gram, '\n', -1)) - 1)").alias("lang"), phrase.alias("phrase"),
        F.size(F.split(phrase, " ")).alias("words"), "n")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, inside_percent: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    grams = written(frequent_grams(docs, text, lang, least))
    words = F.split("phrase", " ")
    phrases = grams.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), words.alias("w"))

    # A cut after k words; its parts are n-grams of at least the phrase's count, so they are in the table.
    cuts = phrases.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).drop("left")
    cuts = cuts.withColumn("right", F.expr("substring_index(phrase, ' ', k - words)"))
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]).drop("right")
    big = lambda c: F.col(c).cast("decimal(18,0)")
    square = (big("a") * big("a")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    cuts = cuts.withColumn("score", F.call_function("div", square.cast("decimal(38,0)"), (big("l") * big("r")).cast("decimal(38,0)")))
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Every shorter run of words inside a phrase, with the largest count of a phrase around it.
    sizes = F.sequence(F.lit(2), F.col("words") - 1)
    inner = phrases.where("words > 2").select("lang", F.col("a").alias("around"), "words", "w", F.explode(sizes).alias("size"))
    inner = inner.select("lang", "around", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("words") - F.col("size") + 1), lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a")))
    # First in shares of a language, so that its phrases never meet in one task.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("share"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    word = r"[^ \t.,;:!?\n\x0B\f\r]+"
    totals = docs.select(_language(lang).alias("lang"), F.regexp_count(F.col(text).cast("string"), F.lit(word)).alias("c")).groupBy("lang").agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"),
                                            F.col("score").cast("long").alias("score"))


def op13_collocations(spark, sf_dir) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
toks AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM toks GROUP BY lang),
occ AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM toks
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM toks
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM toks),
grams AS (SELECT lang, words, phrase, count(*) AS f FROM occ GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE words > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, CAST(1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand) c
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(f) AS around FROM (
    SELECT lang, f, w[1] || ' ' || w[2] AS phrase FROM cand WHERE words = 3
    UNION ALL SELECT lang, f, w[2] || ' ' || w[3] FROM cand WHERE words = 3) GROUP BY lang, phrase)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, t.n, score
FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE i.around IS NULL OR 100 * i.around < 50 * a
QUALIFY rank <= 2000
"""
