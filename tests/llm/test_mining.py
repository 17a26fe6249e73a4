"""Merkle manifest, personal data and collocations: SQL twins elsewhere; here brute force, bounds and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.llm import collocations, merkle, pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _spans string, idx int, digest string, tree string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


# --- Merkle manifest ----------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text=None):
    cells = (row[0], row[3], row[2], row[4], row[1] if text is None else text)
    return H(*("-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells))


def tree_of(nodes):
    """Root, and the siblings (left, right) of every leaf, level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for i, p in enumerate(places):
            run, j = runs[p // 16], p % 16
            paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            places[i] = p // 16
        nodes = [H(*r) for r in runs]
    return nodes[0], paths


def manifest_of(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        trees[g] = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    subs = [tree_of([leaf_of(r) for r in trees[g]]) for g in order]
    root, tops = tree_of([s[0] for s in subs])
    out = []
    for g, (sub, paths), top in zip(order, subs, tops):
        for r, path in zip(trees[g], paths):
            claim = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                claim = leaf_of(r, re.sub("[A-Z]", lambda m: m[0].lower(), r[1]))
            for left, right in path + top:
                claim = H(left, claim, right)
            out.append((r[0], leaf_of(r), sub, root, H(*(a + b for a, b in path + top)), claim, claim == root))
    return sorted(map(repr, out))


def merkle_rows(spark, rows):
    docs = made(spark, rows)
    low = merkle.leaf([merkle.lower_case(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS])
    out = merkle.manifest(docs, claimed=F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, low))
    return sorted(repr(tuple(r)) for r in out.collect())


@pytest.mark.parametrize("rows", [
    [(7, "One", "en", "a", 3)],
    [(None, None, None, None, None), (None, "A", None, "", 1), (3, "B", "en", "s", 1), (3, "b", "en", "s", 1), (3, "b", "en", "s", 1), (5, "É A", "", "Z", None)],
    [(i, f"Text {i}", "en", "a", i) for i in range(16)] + [(i, "T", "en", "b", i) for i in range(17)],
    [(i, "T", "en", f"s{i}", i) for i in range(300)],
])
def test_manifest_brute_force(spark, rows):
    assert merkle_rows(spark, rows) == manifest_of(rows)


def test_manifest_of_several_blocks(spark):
    """A hot source of more than one block of 4,096 leaves, beside small ones."""
    rows = [(i, f"Hot {i}", "en", "hot", i) for i in range(9000)] + [(i, None, None, f"s{i % 40}", 1) for i in range(200)]
    assert merkle_rows(spark, rows) == manifest_of(rows)


def test_proofs_fold_to_the_root(spark):
    docs = made(spark, [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(100)])
    for r in merkle.manifest(docs, proofs=True).collect():
        assert r.verified and merkle.fold(r.leaf, r.proof) == r.root and merkle.fold("0" * 64, r.proof) != r.root


# --- personal data ------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_of(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            found.append((m.start(), k, m.end()))
    return [(s, k, e) for s, k, e in sorted(found)]


def random_text(seed):
    r = random.Random(seed)
    parts = ["a", "B.", "x_", "@", "@b", ".c", "..", "-", "+", "+1", " ", "  ", "(", ")", "4", "4111 1111", "-1111", "1111", "0", "255", "256", "1.2.3.4",
             "é", "\n", "\U0001F600", "a@b.cd", "%", "+49 (30) 123-4567", "79927398713", "00000000000"]
    return "".join(r.choice(parts) for _ in range(r.randint(0, 60)))


def test_base_patterns_brute_force(spark):
    texts = [random_text(i) for i in range(600)]
    texts += ["a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "a" * 3000, "1" * 3000, "a." * 900 + "@" + "b." * 900 + "c", "+" + "1 " * 900, "4111111111111111 " * 300, None, ""]
    docs = made(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r._base] for r in pii.find(docs).select("doc_id", "_base").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == base_of(t or ""), (i, (t or "")[:80])


def test_very_long_texts_take_linear_time(spark):
    texts = ["a" * 1_000_000 + "@", "1" * 1_000_000, "a." * 400_000 + "@" + "b." * 400_000 + "c", "+" + "1 " * 400_000, "word 10.0.0.1 " * 60_000]
    rows = pii.find(made(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).select("doc_id", F.size("_base"), F.get("_base", F.lit(-1) + F.size("_base")))
    got = {r[0]: (r[1], r[2] and (r[2].start, r[2].end)) for r in rows.collect()}
    assert got == {0: (0, None), 1: (0, None), 2: (1, (0, 1_600_002)), 3: (0, None), 4: (60_000, (14 * 59_999 + 5, 14 * 59_999 + 13))}


def telling(spark):
    """Three windows in which Zorro stands beside one address; the other words are common."""
    filler = " ".join(["plain words of no interest that all texts share"] * 6)
    rows = [(i, f"{filler}\nyou reach Zorro at don@example.com, or ask {w} there.\n{filler} Zorro again", "en", "s", 0) for i, w in enumerate(("anyone", "somebody", "people"))]
    rows += [(10 + i, f"{filler} you reach at or ask there anyone somebody people", "en", "s", 0) for i in range(40)]
    rows += [(60, "Once only at one@example.com stands Unusual", "en", "s", 0), (61, "Zorro in a text without an address", "en", "s", 0)]
    return made(spark, rows)


def test_terms_that_reveal_an_entity_go(spark):
    docs = telling(spark)
    # Zorro stands in three windows and at four other places: 3 of 7; the word "don" is part of the address only.
    loose = {r.doc_id: r.text for r in pii.sanitise(docs, disclosure=0.8).collect()}
    assert loose[0].count("[TERM]") == 2 and "Zorro" not in loose[0] and "[EMAIL]" in loose[0] and "don@" not in loose[0]
    assert loose[61] == "Zorro in a text without an address" and loose[60] == "Once only at [EMAIL] stands Unusual"
    assert loose[10] == docs.where("doc_id = 10").first().text
    strict = {r.doc_id: r.text for r in pii.sanitise(docs, disclosure=0.99).collect()}
    assert "Zorro" in strict[0] and "[EMAIL]" in strict[0]
    # Copies are no evidence: one window is not enough, however often it stands.
    copies = made(spark, [(i, "Unusual beside one@example.com", "en", "s", 0) for i in range(50)] + [(100, "plain words " * 500, "en", "s", 0)])
    assert {r.text for r in pii.sanitise(copies).collect()} == {"Unusual beside [EMAIL]", "plain words " * 500}


def test_certain_terms_are_removed(spark):
    rows = [(i, f"Kryptonym {w} 192.168.0.7 end", "en", "s", 0) for i, w in enumerate(("at", "on", "by"))] + [(9, "at on by end " * 300, "en", "s", 0)]
    got = {r.doc_id: r.text for r in pii.sanitise(made(spark, rows)).collect()}
    assert got[0] == " at [IP] end" and got[9] == rows[-1][1]


def test_personal_data_matches_sql_with_terms(spark, tmp_path):
    import duckdb
    telling(spark).toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    sql = pii.OP12_SQL.replace("0.9 * content", "0.8 * content")
    want = {r[0]: r[6] for r in con.execute(sql).fetchall()}
    rows = pii.find(telling(spark), disclosure=0.8).select("doc_id", pii.span_text("_spans").alias("spans")).collect()
    assert {r.doc_id: r.spans for r in rows} == want and "term:" in want[0]


# --- collocations ---------------------------------------------------------------

def collocations_of(rows, least=10, top=2000):
    total, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i:i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        score, k = min((10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        longer = [b for (g, v), b in f.items() if g == lang and len(v) == 3 and b >= least and (v[:2] == w or v[1:] == w)] if len(w) == 2 else []
        if not any(100 * b >= 50 * a for b in longer):
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for lang, got in out.items() for i, (s, a, p, x, y) in enumerate(sorted(got)[:top]))


def phrase_rows():
    r = random.Random(5)
    vocab = ["a", "B", "of", "the", "New", "York", "city", "é", "x\x1cy", "\U0001F600"]
    rows = [(i, "".join(r.choice(vocab) + r.choice([" ", " ", " ", "\t ", ", ", "\n", ". "]) for _ in range(r.randint(0, 300))), r.choice(["en", "de", None]), "s", 0) for i in range(80)]
    rows += [(90, None, "en", "s", 0), (91, "", None, "s", 0), (92, " .;: ", "fr", "s", 0), (93, "new york city " * 2000, "en", "s", 0), (None, "New York", "en", None, 0), (None, "New York", "en", None, 0)]
    return rows


def test_collocations_brute_force(spark):
    rows = phrase_rows()
    got = sorted(tuple(r) for r in collocations.collocations(made(spark, rows)).collect())
    assert got == collocations_of(rows) and {g[0] for g in got} == {"en", "de", "und"}


@pytest.mark.parametrize("seed", range(10))
def test_summaries_keep_what_is_frequent(seed):
    """Merged in any order and in parts, no code of the least count is lost, and counts are off by ``taken`` at most."""
    rng = np.random.default_rng(seed)
    codes = np.concatenate([rng.integers(0, 50, 600), rng.integers(0, 1 << 32, 5000)]).astype(np.uint32)
    rng.shuffle(codes)
    least = 10
    parts = []
    for piece in np.array_split(codes, 7):
        s = collocations.Summary(codes.size // least + 1)
        for x in np.array_split(piece, 5):
            s.add(*collocations._merged(x, np.ones(x.size, np.int64)))
            s.settle()
        parts.append(s)
    whole = collocations.Summary(codes.size // least + 1)
    for s in parts:
        whole.add(s.codes, s.counts)
    kept = set(whole.survivors(least - sum(s.taken for s in parts)).tolist())
    true = Counter(codes.tolist())
    assert whole.codes.size <= whole.capacity and {c for c, n in true.items() if n >= least} <= kept
    assert whole.taken + sum(s.taken for s in parts) < least


def test_small_summaries_take_from_all(monkeypatch):
    s = collocations.Summary(3)
    for x in ([1, 1, 2, 3], [1, 4, 5, 2], [1, 6, 7, 8]):
        s.add(*collocations._merged(np.array(x, np.uint32), np.ones(4, np.int64)))
        s.settle()
    assert s.codes.size <= 3 and 1 in s.codes.tolist() and s.taken <= 12 // 4
    assert s.counts[s.codes.tolist().index(1)] <= 4 <= s.counts[s.codes.tolist().index(1)] + s.taken


def test_many_partitions_of_the_bitmap(spark, monkeypatch):
    rows = phrase_rows()
    monkeypatch.setattr(collocations, "SUMMARY", 7)
    assert sorted(tuple(r) for r in collocations.collocations(made(spark, rows)).collect()) == collocations_of(rows)


@pytest.mark.parametrize("run", [lambda d: merkle.manifest(d), lambda d: pii.find(d), lambda d: pii.sanitise(d), lambda d: collocations.collocations(d)])
def test_empty_table(spark, run):
    assert run(made(spark, []).where("false")).collect() == []


def test_a_very_long_text_is_cut_between_pieces(spark):
    text = "new york city, " * 150_000 + "x" * 10 + " of the " * 20_000
    assert len(text) > 2 * collocations.SLICE_BYTES
    rows = [(1, text, "en", "s", 0), (2, "", "de", "s", 0), (3, "New York city", "de", "s", 0)]
    assert sorted(tuple(r) for r in collocations.collocations(made(spark, rows)).collect()) == collocations_of(rows)


@pytest.mark.parametrize("held", [1, 40, 10 ** 6])
def test_second_pass_counts_alike_however_little_is_held(monkeypatch, held):
    """Tasks and partitions, called directly: sums on the way, sends on the way, packing."""
    import types

    import pyarrow as pa
    monkeypatch.setattr(collocations, "HELD_TEXTS", held)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 100)
    rows = phrase_rows()[:60]
    parts = 3
    bits = types.SimpleNamespace(value=np.full(collocations.BITS // 8 + 8, 255, np.uint8))
    sent = []
    for at in range(0, len(rows), 20):  # three tasks
        batches = [pa.record_batch({"lang": pa.array([r[2] or "und" for r in rows[i:i + 4]]), "text": pa.array([r[1] for r in rows[i:i + 4]], pa.string())})
                   for i in range(at, at + 20, 4)]
        sent += [x for b in collocations._count(bits, parts)(batches) for x in b.to_pylist()]
    sent.sort(key=lambda x: x["part"])
    out = collocations._add_up(3)([pa.RecordBatch.from_pylist(sent[i:i + 5], pa.schema([("part", pa.int32()), ("rows", pa.int64()), ("size", pa.int64()), ("counts", pa.binary())]))
                                   for i in range(0, len(sent), 5)])
    got = {x["gram"].decode(): x["n"] for b in out for x in b.to_pylist()}
    want = Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            want.update(f"{lang or 'und'}\n{' '.join(w[i:i + k])}" for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert got == {g: n for g, n in want.items() if n >= 3}
