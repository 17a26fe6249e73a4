"""The ten operators and the pipeline: SQL twins, brute force, round trips, edge cases."""

import gzip
import itertools
import os
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventlens.llm import bpe, chat, decontaminate, language_id, line_dedup, near_dup, packing, queries, substring_dedup, token_counts, topk, warc

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
RNG = random.Random(3)
VOCAB = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 6))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edge_documents():
    base = prose(300, 1)
    other = base.split()
    other[150] = "CHANGED"
    texts = [base, base, " ".join(other), None, "", " \t\n ", "one", "two words", prose(20_000, 2), base.upper(),
             prose(60, 4) + " " + " ".join(base.split()[40:120]) + " " + prose(70, 5), "<|endoftext|> a  b\n\n c", "...!!! 123", "é ü ñ   x\x85y"]
    texts += [f"All rights reserved.\n{prose(30, 100 + i)}\n\nAll rights reserved." for i in range(14)]
    return pd.DataFrame({"doc_id": range(10, 10 + len(texts)), "text": texts, "lang": ["en", None] * (len(texts) // 2),
                         "source": [None if i == 3 else f"s{i}" for i in range(len(texts))], "n_chars": [len(t or "") for t in texts]})


@pytest.fixture(scope="module")
def edge(tmp_path_factory):
    d = tmp_path_factory.mktemp("edge")
    edge_documents().to_parquet(d / "documents.parquet")
    conv = [(1, 2, "assistant", "b\\[INST]"), (1, 1, "user", "a <|im_end|>\n"), (2, None, None, None), (2, 0, "user", "x"), (2, 0, "user", "x"),
            (None, 1, "tool", "\\\\"), (3, 1, "system", ""), (3, 2, "user", "é\U0001F600"), (3, 3, "assistant", None)]
    pd.DataFrame(conv, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(d / "conversations.parquet")
    return str(d)


def same(spark, name, d):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{d}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    cur = con.execute(queries.SQL[name])
    cols = [c[0] for c in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = queries.QUERIES[name](spark, d)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(repr(tuple(r)) for r in got.select(*cols).collect()) == want


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, edge, name):
    same(spark, name, edge)


def test_chat_reads_back_what_went_in(spark, edge):
    out = {r.conv_id: r for r in chat.format_chats(spark.read.parquet(f"{edge}/conversations.parquet")).select(
        "conv_id", chat.read_turns(chat.F.col("formatted")).alias("turns"), chat.read_loss(chat.F.col("segments")).alias("loss"), "valid").collect()}
    assert [tuple(t) for t in out[1].turns] == [("user", "a <|im_end|>\n"), ("assistant", "b\\[INST]")] and out[1].valid
    assert out[1].loss == "b\\[INST]" and not out[2].valid and not out[None].valid and out[3].valid


NASTY = ["", " ", "  a", "a  ", "a \n b", "x<|endoftext|>y <|endoftext|>", "don't 'S 12 345", "ü é  ñ  z", "日本 語 テスト", "a\x1c b \x85 c",
         "​ a", "😀 😀😀", "\t\t a\r\n b", "naïve_ _x", "ʼn ՘ b", prose(500, 9)]


def test_chunked_ids_equal_the_library():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = bpe.encoder("byte_bpe_50k.json")
    r = random.Random(5)
    alphabet = "ab 1'!\n\t é 日՘ \x85s"
    texts = NASTY + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    ids = bpe.ChunkCache(lambda c: bpe.packed(enc.chunk(c)), limit=50)
    for t in texts:
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(bpe.ids_bytes(enc, ids, t), "<u4").tolist() == want, repr(t)
        assert bpe.count(enc, bpe.ChunkCache(lambda c: len(enc.chunk(c))), t) == len(want)


def test_token_counts(spark, edge):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(edge_documents()[["doc_id", "text"]].values)
    for r in token_counts.op2_token_counts(spark, edge).collect():
        t = texts[r.doc_id] or ""
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 1024)


def test_packing_holds_every_id_once(spark, edge):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in edge_documents()[["doc_id", "text"]].values}
    rows = packing.op3_packing(spark, edge).collect()
    sequences, covered = {}, {i: [] for i in ids}
    for r in rows:
        cut = ids[r.doc_id][r.start:r.start + r.length]
        assert (len(cut), r.doc_tokens, r.ids_crc32) == (r.length, len(ids[r.doc_id]), zlib.crc32(np.array(cut, "<u4").tobytes()))
        covered[r.doc_id] += range(r.start, r.start + r.length)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sorted(covered[i]) == list(range(len(ids[i]))) for i in ids)
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0


@pytest.mark.parametrize("seed", range(20))
def test_balance_is_exact(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, 63) for _ in range(r.randint(0, 200))]
    seqs = packing.balance(lengths, 64, 1.0, 1 / 64)
    got = sorted((i, s, n) for seq in seqs for i, s, n in seq)
    for i, length in enumerate(lengths):
        at = 0
        for _, s, n in [g for g in got if g[0] == i]:
            assert s == at and n > 0
            at += n
        assert at == length
    sums = [sum(n for *_, n in seq) for seq in seqs]
    assert sums.count(64) >= sum(lengths) // 64 and all(x & (x - 1) == 0 for x in sums)


def test_top_k_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(int(i), r.normal(size=8).round(2).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, None), (303, [1.0, None] + [0.0] * 6), (304, [float("nan")] * 8), (305, [float("inf")] * 8),
             (306, [1.0, 2.0]), (350, [0.0] * 8), (400, [3e8] * 8), (450, []), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": chat.F.lit(1), "score": chat.F.lit(2)})
    got = {(x.query_id, x.rank, x.vec_id, x.score) for x in topk.top_k(df, chat.F.col("vec_id") % 50 == 0, shard_rows=64, block_rows=3).collect()}
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i, q in ok:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))[:5]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert got == want


def test_masks_miss_no_overlap():
    """Any two substitutions in a window leave one mask somewhere on unchanged words."""
    w = decontaminate.WINDOW
    for n in range(decontaminate.ERRORS + 1):
        for bad in itertools.combinations(range(w), n):
            assert any(all(c == "0" or o + i not in bad for i, c in enumerate(m)) for m in decontaminate.MASKS for o in range(w - len(m) + 1))


def test_decontamination_brute_force(spark):
    items = [prose(n, 50 + n) for n in (13, 16, 30, 12)] + [None, ""]
    r, docs = random.Random(8), []
    for i in range(120):
        w = prose(60, 1000 + i).split()
        part = r.choice(items[:4]).split()
        at, n = r.randint(0, 3), r.randint(10, 30)
        part = part[at:at + n]
        for _ in range(r.randint(0, 3)):
            part[r.randrange(len(part))] = "zzz"
        docs.append(" ".join(w[:20] + [x.upper() for x in part] + w[20:]))
    docs += [None, "", items[0], prose(30_000, 6) + " " + items[2]]
    want = set()
    windows = [tuple(t.split()[i:i + 13]) for t in items if t for i in range(len(t.split()) - 12)]
    for i, d in enumerate(docs):
        w = (d or "").lower().split()
        here = [w[j:j + 13] for j in range(len(w) - 12)] if len(w) < 1000 else [w[j:j + 13] for j in range(len(w) - 60, len(w) - 12)]
        if any(sum(a != b for a, b in zip(x, y)) <= 2 for x in here for y in windows):
            want.add(i)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame([(i, d, 0) for i, d in enumerate(docs)], "doc_id long, text string, _text_hash int")
    assert {x.id for x in decontaminate.overlaps(df, bench).collect()} == want and 20 < len(want) < 120
    kept = decontaminate.decontaminate(df, bench)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == set(range(len(docs))) - want
    assert decontaminate.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_decontamination_by_short_items(spark, tmp_path):
    import corpus_pipeline
    r = random.Random(8)
    items = [(i, " ".join(f"w{r.randint(0, 3)}" for _ in range(1 + i % 12))) for i in range(24)][1:] + [(99, ""), (98, " \n"), (97, prose(30, 77))]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(100, "Solo")]
    docs = [(i, " ".join([prose(20, 500 + i), *(f"W{r.randint(0, 3)}" for _ in range(r.randint(1, 14))), prose(i % 20, 600 + i)])) for i in range(60)]
    docs += [(100, items[5][1]), (101, "solo"), (102, "a solo b solo"), (103, None), (104, ""), (105, "so lo"), (106, " ".join(prose(30, 77).split()[3:20]))]
    want = {}
    for d, text in docs:
        words = (text or "").lower().split()
        hits = [(i, at, len(w)) for i, t in items if 0 < len(w := t.lower().split()) < decontaminate.WINDOW
                for at in range(len(words) - len(w) + 1) if words[at:at + len(w)] == w]
        if hits:
            want[d] = min(hits, key=lambda h: (h[0], h[1], -h[2]))
    want[106] = (97, 0, 13)
    pd.DataFrame(docs, columns=["doc_id", "text"]).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame(items, columns=["item_id", "text"]).to_parquet(tmp_path / "benchmark.parquet")
    got = decontaminate.op6_decontaminate(spark, str(tmp_path)).collect()
    assert {x.doc_id: (x.item_id, x.first_word, x.matched) for x in got} == want
    assert 20 < len(want) < 64 and want[102] == (100, 1, 1)
    kept = corpus_pipeline.drop_contaminated(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    assert {x.doc_id for x in kept.collect()} == {d for d, _ in docs} - set(want)


def test_suffix_automaton_against_search():
    r = random.Random(2)
    for _ in range(50):
        a = [bytes([r.randrange(3)]) for _ in range(r.randint(0, 60))]
        b = [bytes([r.randrange(3)]) for _ in range(r.randint(4, 60))]
        have = {tuple(a[i:i + 4]) for i in range(len(a) - 3)}
        assert substring_dedup.SuffixAutomaton(a).repeats(b, 4).tolist() == [tuple(b[i:i + 4]) in have for i in range(len(b) - 3)]


def test_near_duplicates_in_large_groups(spark):
    """Variants of one text in a chain and a crowd: components as by comparing all pairs."""
    r, texts = random.Random(4), []
    for i in range(150):
        w = prose(40, 77).split()
        for _ in range(r.randint(0, 6)):
            w[r.randrange(40)] = r.choice(VOCAB)
        texts.append(" ".join(w))
    sets = [{tuple(w[j:j + 2]) for j in range(len(w) - 1)} for w in map(str.split, texts)]
    parent = list(range(150))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(range(150), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near_dup.near_duplicates(df, shingle=2).collect()}
    assert got == {i: find(i) for i in range(150)}


def test_near_duplicates_of_repeated_and_null_ids(spark):
    """Rows are judged by id and text: of every component one row stays, whatever its id."""
    r = random.Random(8)
    groups = [prose(60, 300 + g).split() for g in range(12)]
    rows = []
    for i in range(150):
        g = r.randrange(12)
        w = list(groups[g])
        if r.random() < 0.4:
            w[r.randrange(60)] = f"x{i}"
        rows.append((r.choice([None, *range(20)]), " ".join(w), g))
    rows += [(3, "", None), (3, "", None), (None, None, None), rows[5], rows[5]]
    df = spark.createDataFrame([(i, t, None if g is None else str(g)) for i, t, g in rows], "doc_id long, text string, source string")
    best = {}
    for i, t, g in rows:
        if g is not None:
            best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    got = near_dup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = sorted(((i, None if best[g][0] else best[g][1]) if g is not None else (i, i) for i, t, g in rows), key=repr)
    assert sorted(((x.doc_id, x.component_id) for x in got), key=repr) == want
    kept = near_dup.drop_near_duplicates(df).collect()
    assert sorted(str(x.source) for x in kept) == sorted([str(g) for g in best] + ["None"] * 3)
    assert all((x.doc_id is None, x.doc_id or 0) == best[int(x.source)] for x in kept if x.source)


def test_two_components_of_many_variants_meet_once(spark):
    """Thousands of members of one bucket in two components, with one bridge between them."""
    base = prose(400, 77).split()
    other = base[:340] + prose(60, 78).split()
    made = []
    for i in range(1500):
        for w in (base, other):
            v = list(w)
            v[i % 330] = f"v{i}"
            made.append(" ".join(v))
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    sizes = sorted(x["count"] for x in near_dup.near_duplicates(docs).groupBy("component_id").count().collect())
    assert sizes == [1500, 1500]
    bridge = " ".join(base[:370] + prose(30, 79).split())
    docs = docs.unionByName(spark.createDataFrame([(9000, bridge), (9001, " ".join(base[:345] + prose(55, 78).split()))], docs.schema))
    assert near_dup.near_duplicates(docs).select("component_id").distinct().count() <= 2


def test_kernel_of_long_texts_by_stretches(spark):
    """A text of several stretches is scored as the mean of its stretches; languages stay apart at any length."""
    a, b = "abcdef ghij ", "uvwxyz qrst "
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(x.split()) + r.choice("aeiou") for _ in range(80)), lang) for i, (x, lang) in enumerate([(a, "one"), (b, "two")] * 30)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    long = " ".join(r.choice(a.split()) + r.choice("aeiou") for _ in range(900_000))
    assert len(long) > 5_000_000
    out = language_id.identify(spark.createDataFrame([(1, long), (2, "x" * 300_000), (3, "123")], "doc_id long, text string"), model).collect()
    got = {x.doc_id: (x.lang_pred, x.score) for x in out}
    parts = language_id.stretches(long)
    assert len(parts) == -(-(len(long) + 2) // language_id.STRETCH) and "".join(parts) == f" {long} "
    unit = np.mean([(language_id.unit(language_id.presence(p, model.bits)[None]) @ model.landmarks.T) @ model.weights for p in parts], axis=0)[0]
    assert got[1][0] == "one" and abs(got[1][1] - float(np.clip(unit, 0, 1).max())) < 1e-5 and got[3] == ("und", 0.0)


def test_kernel_brute_force():
    """The blended kernel is the mean over n of the cosine of the n-gram presence sets."""
    texts = ["ab ba", "abc", "zz", "a"]
    sets = [[{f" {t} "[i:i + n] for i in range(len(t) + 3 - n)} for n in language_id.ORDERS] for t in texts]
    got = language_id.unit(np.stack([language_id.presence(language_id.stretches(t)[0], 16) for t in texts]))
    assert got.dtype == np.float32
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            want = np.mean([len(p & q) / (len(p) * len(q)) ** 0.5 if p and q else 0 for p, q in zip(x, y)])
            assert abs(float(got[i] @ got[j]) - want) < 1e-5


def test_language_id_held_out(spark):
    rows = language_id.op8_language_id(spark, DATA).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_language_id_without_letters_or_training(spark, edge):
    out = {r.doc_id: r for r in language_id.op8_language_id(spark, edge).collect()}
    texts = dict(edge_documents()[["doc_id", "text"]].values)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in texts[i] or "")) for i, r in out.items())
    none = language_id.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language_id.identify(spark.createDataFrame([("abc", 1.0)], "text string, score double"), none).collect()} == {"und"}


def test_language_id_learns_languages_of_copies(spark):
    F = chat.F
    texts = {"aa": ["lorem ipsum dolor " + w for w in VOCAB[:8]], "bb": ["zyx wvut zrqp " + w for w in VOCAB[:8]]}
    # 20,000 rows of eight texts, and as many of eight texts among blanks and digits; a share of the rows learns neither.
    rows = (spark.range(40_000).withColumn("lang", F.when(F.col("id") % 2 == 0, "aa").otherwise("bb")).withColumn("k", F.expr("int(id / 2)"))
            .withColumn("text", F.when(F.col("lang") == "aa", F.element_at(F.lit(texts["aa"]), F.expr("int(k % 8) + 1")))
                        .when(F.col("k") % 100 < 8, F.element_at(F.lit(texts["bb"]), F.expr("int(k % 100) + 1"))).otherwise(F.concat(F.lit("1 "), F.col("id")))))
    model = language_id.fit(rows.select("text", "lang"))
    assert model.languages == ("aa", "bb") and len(model.landmarks) == 16
    df = spark.createDataFrame([(t, lang) for lang, ts in texts.items() for t in ts], "text string, lang string")
    assert all(r.lang_pred == r.lang for r in language_id.identify(df, model).collect())


def test_language_id_sample_is_bounded(spark):
    rows = spark.range(6000).selectExpr("concat('text ', translate(string(id), '0123456789', 'abcdefghij')) AS text", "'aa' AS lang")
    assert 240 < len(language_id.fit(rows.unionByName(rows), landmarks=1000).landmarks) < 360


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/é", "<html lang=de><head><title>T &amp; t</title></head><p>a<br>b &lt;<script>x</script><a href='/u'>u</a>"),
                                   (2, None, None), (2, None, None), (3, "http://y", "plain \x00 text")], "page_id long, url string, html string")
    made = warc.responses(pages)
    records = made.unionByName(warc.derive(made))
    rows = records.collect()
    assert len(rows) == 12
    by = {(r.page_id, r.warc_type): r for r in rows}
    assert bytes(by[1, "conversion"].block).decode() == "a\nb <\nu".replace("<\nu", "< u")
    meta = bytes(by[1, "metadata"].block).decode()
    assert "title: T & t\r\n" in meta and "language: de\r\n" in meta and "outlink: /u\r\n" in meta
    head = {h.name: h.value for h in by[1, "conversion"].headers}
    source = {h.name: h.value for h in by[1, "response"].headers}
    assert head["WARC-Refers-To"] == source["WARC-Record-ID"] and head["WARC-Source-Payload-Digest"] == source["WARC-Payload-Digest"]
    assert head["WARC-Block-Digest"] == warc.digest(bytes(by[1, "conversion"].block)) and head["WARC-Target-URI"] == "http://x/é"
    warc.write(records, str(tmp_path / "w"), 5)
    back = warc.read(spark, str(tmp_path / "w")).collect()
    assert sorted((r.record_id, bytes(r.block)) for r in back) == sorted((r.record_id, bytes(r.block)) for r in rows)
    assert list(warc.parse(gzip.compress(b"") or b"")) == []


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def operators(bench):
    return {
        "lines": line_dedup.line_dedup, "tokens": token_counts.token_counts, "pack": packing.pack, "near": near_dup.near_duplicates,
        "keep": near_dup.drop_near_duplicates, "overlaps": lambda d: decontaminate.overlaps(d, bench), "substring": substring_dedup.substring_dedup,
        "language": lambda d: language_id.identify(d, language_id.fit(d))}


def test_empty_tables_give_no_rows(spark):
    empty, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert {k: f(empty).count() for k, f in operators(bench).items()} == {k: 0 for k in operators(bench)}
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), chat.F.col("vec_id") % 50 == 0).count() == 0
    assert warc.derive(warc.responses(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, prose(80, 1), None, None, None), (1, prose(80, 1), "en", "a", 1), (1, prose(80, 1), "en", "a", 1), (2, None, None, None, None)]
    bench = spark.createDataFrame([(1, prose(80, 2)), (None, None)], "item_id long, text string")
    df = spark.createDataFrame(rows, DOCS)
    for name in ("id", "text_hash", "_text_hash", "_gone", "_lines", "_kept", "score", "_n_lines", "rep", "comp", "key", "word", "n"):
        df = df.withColumn(name, chat.F.lit("own"))
    counts = {k: f(df).count() for k, f in operators(bench).items()}
    assert counts["lines"] == counts["tokens"] == counts["language"] == counts["substring"] == 4
    assert counts["near"] == 4 and counts["keep"] == 2 and counts["overlaps"] == 0
    out = line_dedup.line_dedup(df)
    assert {r._gone for r in out.collect()} == {"own"} and {r._n_removed for r in out.collect()} == {0}


def test_pipeline(spark):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in p.STAGES:
        out = p.written(stage(spark, docs, DATA))
        if name == "packing":
            assert out.select("doc_id").distinct().count() == seen[-1]
        else:
            assert out.columns == columns
            seen.append(out.count())
            docs = out
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.7 * seen[0]
    assert decontaminate.overlaps(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).count() == 0
    assert near_dup.near_duplicates(docs).where("not kept").count() == 0
