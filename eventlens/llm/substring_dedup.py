"""Substring dedup: matching statistics of documents against suffix automata.

A word goes if it lies in a window of ``WINDOW`` consecutive words whose word
sequence also starts in a document with a smaller id. Sending every automaton to
every document would cost the square of the corpus, so reference texts are
chosen and routed by content:

1. Every window selects its smallest hash of ``GRAM`` words, so equal windows
   select the same one wherever they stand. Selected grams that occur in
   several documents route a document's windows to the smallest document that
   has the gram: the reference. Copies of a whole word sequence are found by a
   fingerprint and need no routing.
2. Stretches of windows meet their reference in a task, sorted behind it. The
   suffix automata of the reference's shards (``SHARD`` words, overlapping by a
   window) are built once, and the stretches stream through them: wherever the
   matching statistic reaches ``WINDOW``, the window is a repeat. A reference
   with very many stretches is dealt over several tasks, each of which gets its
   text once.
3. A window that its reference lacks, though the reference has its gram, may
   still repeat another smaller document. All documents that share such a
   window send it here, so grouping these by a 128-bit hash decides them.

Words are compared as bytes in step 2. Windows are judged on the input.

Defined results: null, empty or short texts have no window and keep all words;
rows of null id keep all and lend nothing; repeats inside one id do not count;
rows of one id with different texts are judged one by one; repeated rows are
judged alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import mix, per_task, slices, small_batches, table, words, written

WINDOW, GRAM, SHARD = 50, 25, 20_000
#: Routes to one reference that one task takes, about.
ROUTES = 8192
_BASE = 0xD6E8FEB86659FD93


def _runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, from one prefix sum."""
    n = h.size - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = np.full(h.size, _BASE, np.uint64), np.full(h.size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(up))])
    return mix((total[k:] - total[:-k]) * np.cumprod(down)[:n])


def _sliding(x: np.ndarray, k: int, op) -> np.ndarray:
    """``op`` over every k consecutive values, by doubling."""
    width = 1
    while 2 * width <= k:
        x = op(x[:-width], x[width:])
        width *= 2
    return op(x[:x.size - (k - width)], x[k - width:]) if width < k else x


def selected(h: np.ndarray) -> np.ndarray:
    """The selected gram of every window."""
    grams = _runs(h, GRAM)
    per = WINDOW - GRAM + 1
    return _sliding(grams, per, np.minimum) if grams.size >= per else np.empty(0, np.uint64)


class SuffixAutomaton:
    """All substrings of a word sequence; states are right-context classes."""

    def __init__(self, sequence: list[bytes]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for w in sequence:
            last = self._extend(last, w)

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if length[p] + 1 != length[q]:
                copy = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        return new

    def repeats(self, sequence: list[bytes], k: int) -> np.ndarray:
        """For every window of k words of the sequence, whether the automaton has it."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        out = bytearray(len(sequence))
        for i, w in enumerate(sequence):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            out[i] = matched >= k
        return np.frombuffer(bytes(out), np.uint8)[k - 1:].astype(bool)


_SIGNED = "id long, text_hash long, n long, f1 long, f2 long, words_sha256 string, grams array<long>"


def _sign(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            w = words(part.column("text"))
            n, f1, f2, sha, grams = [], [], [], [], []
            for i in range(part.num_rows):
                own = w.of(i)
                print_ = xxhash.xxh3_128_intdigest(own.tobytes())
                n.append(own.size)
                f1.append((print_ >> 64) - (1 << 63))
                f2.append((print_ & (1 << 64) - 1) - (1 << 63))
                sha.append(hashlib.sha256(b" ".join(w.texts(i))).hexdigest())
                grams.append(np.unique(selected(own)).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([g.size for g in grams])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("text_hash"), *(pa.array(x, pa.int64()) for x in (n, f1, f2)), pa.array(sha, pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(grams)))],
                names=["id", "text_hash", "n", "f1", "f2", "words_sha256", "grams"])


def _stretches(batches):
    """Texts with their routes (gram, reference, tasks of the reference) to runs of windows with one reference."""
    for batch in batches:
        for part in slices(batch, "text"):
            w = words(part.column("text"))
            at, ref, task, start, text = [], [], [], [], []
            for i in range(part.num_rows):
                routes = part.column("routes")[i].values
                gram, to, tasks = (routes.field(k).to_numpy() for k in (0, 1, 2))
                order = np.argsort(gram)
                gram, to, tasks = gram[order], to[order], tasks[order]
                own = part.column("text_hash")[i].as_py()
                chosen = selected(w.of(i)).view(np.int64)
                place = np.minimum(np.searchsorted(gram, chosen), gram.size - 1)
                hit = gram[place] == chosen
                goal = to[place]
                cuts = np.flatnonzero(np.diff(hit.astype(np.int8) * 1, prepend=0) | (np.diff(goal, prepend=goal[:1]) != 0))
                for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), chosen.size], strict=True):
                    if hit[s]:
                        lo, hi = w.starts[w.bounds[i] + s], w.ends[w.bounds[i] + e - 1 + WINDOW - 1]
                        at.append(i)
                        ref.append(int(goal[s]))
                        task.append((own + s) % int(tasks[place[s]]))
                        start.append(s)
                        text.append(w.data[lo:hi].tobytes())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id").take(take), part.column("text_hash").take(take), pa.array(ref, pa.int64()),
                                              pa.array(task, pa.int64()), pa.array(start, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())],
                                             names=["id", "text_hash", "ref", "task", "start", "words"])


def _match(batches):
    """A reference's texts (no start), then its stretches, to spans of repeats, and to open windows with their hash."""
    held, automata = None, []
    for batch in batches:
        rows = []
        for part in slices(batch, "words"):
            w = words(part.column("words"))
            keys = zip(part.column("ref").to_pylist(), part.column("task").to_pylist(), strict=True)
            ids, texts, starts = (part.column(k).to_pylist() for k in ("id", "text_hash", "start"))
            for i, key in enumerate(keys):
                seq = w.texts(i)
                if held != key:
                    held, automata = key, []
                if starts[i] is None:
                    automata += [SuffixAutomaton(seq[at:at + SHARD]) for at in range(0, max(1, len(seq) - WINDOW + 1), SHARD - WINDOW + 1)]
                    continue
                found = np.zeros(len(seq) - WINDOW + 1, bool)
                for a in automata:
                    found |= a.repeats(seq, WINDOW)
                edge = np.flatnonzero(np.diff(found.astype(np.int8), prepend=0, append=0))
                for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    rows.append((ids[i], texts[i], starts[i] + s, starts[i] + e - 1 + WINDOW, None, None))
                if not found.all():
                    u1, u2 = (_runs(x, WINDOW).view(np.int64).tolist() for x in (w.of(i), mix(w.of(i) ^ np.uint64(0xA0761D6478BD642F))))
                    rows += [(ids[i], texts[i], starts[i] + s, starts[i] + s + WINDOW, u1[s], u2[s]) for s in np.flatnonzero(~found).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)],
                                         names=["id", "text_hash", "first", "last", "u1", "u2"])


def _cut(batches):
    """Texts with spans to the kept words, and the merged spans."""
    for batch in batches:
        for part in slices(batch, "text"):
            w = words(part.column("text"))
            removed, kept = [], []
            for i in range(part.num_rows):
                own = w.texts(i)
                spans = part.column("spans")[i].values
                gone = np.zeros(len(own) + 1, np.int64)
                np.add.at(gone, spans.field(0).to_numpy(), 1)
                np.add.at(gone, spans.field(1).to_numpy(), -1)
                stays = np.cumsum(gone[:-1]) == 0
                removed.append(int((~stays).sum()))
                kept.append(b" ".join([x for x, s in zip(own, stays.tolist(), strict=True) if s]))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "text_hash", "n_removed", "kept"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``words_sha256`` (of all its words) and ``kept``: the kept words
    joined by blanks where any word went, else null (the text is as it was)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"), F.col(text).cast("string").alias("text"))
    signed = written(rows.mapInArrow(per_task(_sign), _SIGNED))
    long_ones = signed.where(F.col("id").isNotNull() & (F.col("n") >= WINDOW))
    firsts = long_ones.groupBy("f1", "f2").agg(F.min("id").alias("rep"))
    copies = long_ones.join(firsts, ["f1", "f2"]).select("id", "text_hash", "n", (F.col("id") != F.col("rep")).alias("copy"))

    grams = long_ones.select("id", "text_hash", F.explode("grams").alias("gram"))
    shared = grams.groupBy("gram").agg(F.min("id").alias("ref"), F.max("id").alias("z"), F.count("*").alias("n")).where("ref != z")
    loads = shared.groupBy("ref").agg(F.ceil(F.sum("n") / ROUTES).alias("tasks"))
    shared = shared.join(loads, "ref").select("gram", "ref", "tasks")
    routes = (grams.join(shared, "gram").where("id != ref")
              .join(copies.where("not copy").select("id", "text_hash").distinct(), ["id", "text_hash"])
              .groupBy("id", "text_hash").agg(F.collect_set(F.struct("gram", "ref", "tasks")).alias("routes")))
    routes = written(routes)
    refs = routes.select(F.explode("routes").alias("r")).select(F.col("r.ref").alias("id"), "r.tasks").distinct()
    wanted = (routes.select("id").unionByName(refs.select("id"))).distinct()
    texts = written(rows.join(wanted, "id", "left_semi").dropDuplicates(["id", "text_hash"]))

    stretches = texts.join(routes, ["id", "text_hash"]).select("id", "text_hash", "text", "routes").mapInArrow(
        per_task(_stretches), "id long, text_hash long, ref long, task long, start long, words string")
    none = F.lit(None).cast("long")
    ref_texts = texts.join(refs, "id").select("id", "text_hash", F.col("id").alias("ref"), F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"),
                                              none.alias("start"), F.col("text").alias("words"))
    met = ref_texts.unionByName(stretches).repartition("ref", "task").sortWithinPartitions("ref", "task", "start")
    found = written(met.mapInArrow(per_task(_match), "id long, text_hash long, first long, last long, u1 long, u2 long"))
    open_ones = found.where("u1 is not null")
    shared = open_ones.groupBy("u1", "u2").agg(F.min("id").alias("m"), F.max("id").alias("z")).where("m != z")
    decided = open_ones.join(shared, ["u1", "u2"]).where("id != m")
    spans = (found.where("u1 is null").select("id", "text_hash", "first", "last")
             .unionByName(decided.select("id", "text_hash", "first", "last"))
             .groupBy("id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("spans")))
    changed = (texts.join(spans, ["id", "text_hash"]).select("id", "text_hash", "text", "spans")
               .mapInArrow(per_task(_cut), "id long, text_hash long, n_removed long, kept string"))
    whole = copies.where("copy").select("id", "text_hash", F.col("n").alias("n_removed"), F.lit("").alias("kept")).distinct()
    gone = changed.unionByName(whole)
    out = signed.select("id", "text_hash", F.col("n").alias("n_words"), "words_sha256").join(gone, ["id", "text_hash"], "left")
    return out.select(F.col("id").alias(id_col), "text_hash", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "words_sha256", "kept")


def op7_substring_dedup(spark, sf_dir) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.coalesce(F.sha2("kept", 256), "words_sha256").alias("kept_sha256"))


OP7_SQL = r"""
WITH toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
wins AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM toks WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS m FROM wins GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM wins JOIN firsts USING (h) WHERE doc_id <> m),
pos AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM toks)),
kept AS (
  SELECT pos.doc_id, count(gone.p) AS n_removed, coalesce(string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY pos.p), '') AS k
  FROM pos LEFT JOIN gone ON pos.doc_id = gone.doc_id AND pos.p = gone.p GROUP BY pos.doc_id)
SELECT toks.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM toks LEFT JOIN kept USING (doc_id)
"""
