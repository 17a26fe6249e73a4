"""Near-duplicate groups by min-max hashing, confirmed on full shingle sets.

A text's set is its distinct runs of ``shingle`` words (A-Z lower-cased). Every
permutation of the set gives two signature values, its minimum and its maximum,
so a signature of ``2 * PERMS`` values costs ``PERMS`` hash evaluations a
shingle. Each value agrees between two texts with probability J (their
similarity), and the pair of one permutation agrees or not with a lower variance
than two permutations would. Bands of four values (two permutations) are
buckets: a pair of J = 0.8 shares none of the 40 with a probability below 1e-8
(1.8e-8 if the pair has only five shingles in all: minimum and maximum of few
members agree less often together).

Texts of equal sets form a class first, by a 128-bit fingerprint; only one
representative of a class goes on. In the buckets, links are sought in three
rounds, each on what the rounds before left in different components:

1. every class against the smallest member it shares a bucket with;
2. every class against the smallest member of each of its buckets;
3. in buckets that still hold several components, all members across
   components: blocks of bounded size meet inside the tasks with their sets.
   Members of a bucket's largest component meet the others only, and a block
   joins components as it finds links, so that two components are compared until
   their first link and leave the task as one row.

Any candidate is confirmed by comparing the full sets, built anew from the
texts (in round three: carried there). Large groups of copies cost one
comparison a member; no pairs of a group are listed. Components come from
alternating stars; a later round contracts the components of the earlier ones
and joins only these.

Defined results: a document is a row, known by its id and the hash of its text,
so different texts of one id are judged apart; null or blank texts have an empty
set and no links; with fewer words than a shingle the whole sequence is the one
shingle; a null id counts as larger than all others, and a component of null ids
only has the null id; the filter keeps one row of every component, the one with
the smallest id, then the smallest text hash, and one of several equal rows, while rows without
words all stay; other columns are ignored or pass through; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import combine, per_task, shielded, shingles, slices, small_batches, table, words, written
from eventlens.llm.components import components

PERMS, PER_BAND = 80, 2
BANDS = PERMS // PER_BAND
#: Members and shingles of a block in round three, about.
BLOCK, BLOCK_CODES = 1024, 1 << 20
#: Hashes are looked up by this many bits.
PLACES = 20
_RNG = np.random.default_rng(11)
_MUL = _RNG.integers(0, 1 << 63, (PERMS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RNG.integers(0, 1 << 63, (PERMS, 1), dtype=np.uint64)


def signature(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of a set under each permutation."""
    low, high = np.full(PERMS, ~np.uint64(0)), np.zeros(PERMS, np.uint64)
    for at in range(0, members.size, 2048):
        x = (members[None, at:at + 2048] ^ _XOR) * _MUL
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One bucket key a band; the band's number is part of it."""
    cols = [v[i::PER_BAND] for i in range(PER_BAND) for v in (low, high)]
    return combine([np.arange(BANDS, dtype=np.uint64), *cols])


_SIGNED = "id long, text_hash long, n long, f1 long, f2 long, bands array<long>"


def _sign(shingle: int):
    def signed(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), lower=True)
                n, f1, f2, bands = [], [], [], []
                for i in range(part.num_rows):
                    own = shingles(w.of(i), shingle)
                    print_ = xxhash.xxh3_128_intdigest(own.tobytes())
                    low, high = signature(own)
                    n.append(own.size)
                    f1.append((print_ >> 64) - (1 << 63))
                    f2.append((print_ & (1 << 64) - 1) - (1 << 63))
                    bands.append(band_keys(low, high).view(np.int64) if own.size else np.empty(0, np.int64))
                offsets = np.concatenate([[0], np.cumsum([b.size for b in bands])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text_hash"), *(pa.array(x, pa.int64()) for x in (n, f1, f2)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(bands)))],
                    names=["id", "text_hash", "n", "f1", "f2", "bands"])
    return signed


def _confirm(shingle: int, percent: int):
    """Pairs with both texts to the pairs whose full sets are similar enough."""
    def confirmed(batches):
        for batch in batches:
            for part in slices(batch, "text_b"):
                wa, wb = words(part.column("text_a"), lower=True), words(part.column("text_b"), lower=True)
                at = []
                for i in range(part.num_rows):
                    x, y = shingles(wa.of(i), shingle), shingles(wb.of(i), shingle)
                    both = np.intersect1d(x, y, assume_unique=True).size
                    if x.size and y.size and 100 * both >= percent * (x.size + y.size - both):
                        at.append(i)
                yield part.select(["a", "b"]).take(pa.array(at, pa.int64()))
    return confirmed


def _sets(shingle: int):
    """Texts to their sets, as they travel in round three."""
    def made(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), lower=True)
                own = [shingles(w.of(i), shingle).tobytes() for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(own, pa.binary())], names=["node", "members"])
    return made


class Joined(dict):
    """Components of a block, joined as links are found."""

    def root(self, c: int) -> int:
        while (up := self.get(c, c)) != c:
            self[c] = c = self.get(up, up)
        return c


def _across(percent: int):
    """Blocks of bucket members to the pairs of components that have a link there."""
    places = np.zeros(1 << PLACES, bool)

    def links(rows):
        comps, side = [r[1] for r in rows], np.array([r[3] for r in rows])
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        n = np.array([x.size for x in sets])
        codes = [(x >> np.uint64(64 - PLACES)).astype(np.int64) for x in sets]
        joined = Joined()
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        for i in left.tolist():
            roots = {c: joined.root(c) for c in set(comps)}
            root = np.array([roots[c] for c in comps])
            to = right[(root[right] != root[i]) & ((right > i) | (side[right] > 0))]
            to = to[100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i])]
            if not to.size:
                continue
            # By the upper bits of the hashes first, which can only overstate what is shared.
            places[codes[i]] = True
            hits = places[np.concatenate([codes[k] for k in to.tolist()])]
            shared = np.add.reduceat(hits, np.concatenate([[0], np.cumsum(n[to])[:-1]]), dtype=np.int64)
            places[codes[i]] = False
            for k in to[100 * shared >= percent * (n[to] + n[i] - shared)].tolist():
                x, y = joined.root(comps[i]), joined.root(comps[k])
                if x != y:
                    both = np.intersect1d(sets[i], sets[k], assume_unique=True).size
                    if 100 * both >= percent * (n[i] + n[k] - both):
                        joined[max(x, y)] = min(x, y)
                        yield comps[i], comps[k]

    def made(batches):
        key, held, out = None, [], set()
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != key:
                    if len(held) > 1:
                        out.update(links(held))
                    key, held = row[0], []
                held.append(row)
            if len(out) > 10_000:
                yield _pairs(out)
                out = set()
        if len(held) > 1:
            out.update(links(held))
        if out:
            yield _pairs(out)
    return made


def _pairs(found) -> pa.RecordBatch:
    found = sorted(found)
    return pa.RecordBatch.from_arrays([pa.array([int(p[i]) for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"), F.col(text).cast("string").alias("text"))


def _grouped(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per row (id, text_hash): ``n``, and the ``best`` row (null last, id, text_hash) of its component; null without words."""
    small_batches(rows.sparkSession)
    signed = written(rows.mapInArrow(per_task(_sign(shingle)), _SIGNED))
    known = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    classes = written(signed.where("n > 0").groupBy("f1", "f2")
                      .agg(F.min(known).alias("best"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"))
                      .withColumn("node", F.monotonically_increasing_id()))

    banded = classes.select("node", "n", F.explode("bands").alias("bucket"))
    first = banded.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("a"), F.max("node").alias("z")).where("a.node != z")
    # Members of buckets with several classes, each with the bucket's smallest.
    members = written(banded.join(first.select("bucket", F.col("a.node").alias("a"), F.col("a.n").alias("na")), "bucket"))
    stars = members.where("node != a").where(F.least("n", "na") * 100 >= F.greatest("n", "na") * percent)
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "best.id", "best.text_hash")
    texts = written(rows.join(wanted, rows["id"].eqNullSafe(wanted["id"]) & (rows["text_hash"] == wanted["text_hash"]))
                    .dropDuplicates(["node"]).select("node", "text"))

    def confirm(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        with_ab = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        return with_ab.select("a", "b", "text_a", "text_b").mapInArrow(per_task(_confirm(shingle, percent)), "a long, b long")

    def labelled(df: DataFrame, ids: str, name: str, comps: DataFrame) -> DataFrame:
        of = comps.select(F.col("id").alias(ids), F.col("comp").alias(name))
        return df.join(of, ids, "left").withColumn(name, F.coalesce(F.col(name), F.col(ids)))

    def contracted(comps: DataFrame, links: DataFrame) -> DataFrame:
        """Components after links between components."""
        merged = components(links)
        old = labelled(comps.withColumnRenamed("comp", "was"), "was", "comp", merged).select("id", "comp")
        return written(old.unionByName(merged.join(comps, "id", "left_anti")))

    one_each = stars.groupBy(F.col("node").alias("b")).agg(F.min("a").alias("a")).select("a", "b")
    comps = written(components(confirm(one_each)))
    more = stars.select("a", F.col("node").alias("b")).distinct().join(one_each, ["a", "b"], "left_anti")
    more = confirm(labelled(labelled(more, "a", "ca", comps), "b", "cb", comps).where("ca != cb").select("a", "b"))
    more = labelled(labelled(more, "a", "ca", comps), "b", "cb", comps).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    comps = contracted(comps, more)

    # Round three: a bucket's smallest member has met all others by now.
    left = labelled(members.where("node != a").select("bucket", "node", "n"), "node", "comp", comps)
    parts = left.groupBy("bucket", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    mixed = parts.groupBy("bucket").agg(F.max(F.struct("m", "comp", "s")).alias("top"), F.count("*").alias("k"), F.sum("m").alias("m"), F.sum("s").alias("s")).where("k > 1")
    blocks = lambda m, s: F.ceil(F.greatest(m / BLOCK, s / BLOCK_CODES)).cast("int")
    mixed = mixed.select("bucket", F.col("top.comp").alias("top"), blocks(F.col("top.m"), F.col("top.s")).alias("homes"),
                         blocks(F.col("m") - F.col("top.m"), F.col("s") - F.col("top.s")).alias("guests"))
    held = left.join(mixed, "bucket").withColumn("home", F.col("comp") == F.col("top"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))).cast("int")
    held = held.withColumn("own", own)
    to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = lambda kind, x, y, side: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), side.cast("int").alias("side"))
    met = F.when(F.col("home"), F.transform(to("guests"), lambda j: block(0, F.col("own"), j, F.lit(-1)))).otherwise(F.concat(
        F.transform(to("homes"), lambda i: block(0, i, F.col("own"), F.lit(1))),
        F.transform(to("guests"), lambda j: block(1, F.least("own", j), F.greatest("own", j), F.signum(F.col("own") - j)))))
    dealt = held.select("node", "comp", "bucket", F.explode(met).alias("at")).select(
        F.xxhash64("bucket", "at.kind", "at.x", "at.y").alias("key"), "node", "comp", "at.side")
    sets = texts.join(dealt.select("node").distinct(), "node", "left_semi").mapInArrow(per_task(_sets(shingle)), "node long, members binary")
    meeting = dealt.join(sets, "node").select("key", "comp", "members", "side")
    found = meeting.repartition("key").sortWithinPartitions("key").mapInArrow(per_task(_across(percent)), "a long, b long").distinct()
    comps = contracted(comps, found)

    groups = labelled(classes.select("node", "f1", "f2", "best"), "node", "comp", comps)
    best = written(groups.groupBy("comp").agg(F.min("best").alias("best")))
    of_class = groups.select("f1", "f2", "comp").join(best, "comp").select("f1", "f2", "best")
    return signed.select("id", "text_hash", "n", "f1", "f2").join(of_class, ["f1", "f2"], "left").select(
        "id", "text_hash", "n", F.when(F.col("n") > 0, F.col("best")).alias("best"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id``, ``kept``. Texts with 100 * shared >= percent * joint shingles are linked."""
    out = _grouped(_rows(docs, id_col, text), shingle, percent)
    comp = F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp.alias("component_id"), F.col("id").eqNullSafe(comp).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component; rows without words stay."""
    judged = written(_grouped(_rows(docs, id_col, text), shingle, percent).where("best IS NOT NULL"))
    own = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    gone = judged.where(own != F.col("best")).select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(True).alias("_gone")).distinct()
    twice = judged.where(own == F.col("best")).groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count("*").alias("_n")).where("_n > 1")
    marks = gone.unionByName(twice.select("_id", "_hash", F.lit(False).alias("_gone")))
    docs, back = shielded(docs, {"_id", "_hash", "_gone", "_text_hash"})
    rows = docs.withColumn("_text_hash", F.xxhash64(F.col(text).cast("string")))
    marked = rows.join(marks, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left")
    alone = marked.where("_gone IS NULL").select(*docs.columns)
    one = marked.where("NOT _gone").dropDuplicates(["_id", "_hash"]).select(*docs.columns)
    return alone.unionByName(one).withColumnsRenamed(back)


def op4_near_duplicates(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


OP4_SQL = r"""
WITH RECURSIVE toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM toks),
cls AS (SELECT list_sort(s) AS s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
sh AS (SELECT rep, n, unnest(s) AS x FROM cls),
pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM sh a JOIN sh b ON a.x = b.x AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a AS u, b AS v FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT rep AS u, rep AS r FROM cls UNION SELECT e.v, reach.r FROM reach JOIN edges e ON e.u = reach.u AND reach.r < e.v),
comp AS (SELECT u, min(r) AS c FROM reach GROUP BY u)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(comp.c, sets.doc_id) AS component_id,
  coalesce(comp.c, sets.doc_id) = sets.doc_id AS kept
FROM sets LEFT JOIN cls ON list_sort(sets.s) = cls.s LEFT JOIN comp ON comp.u = cls.rep
"""
