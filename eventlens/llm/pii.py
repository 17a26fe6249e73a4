r"""Personal data: base patterns, and the terms of a corpus that reveal them.

Base findings are e-mail addresses, IP addresses, card numbers (12 to 19 digits,
Luhn) and phone numbers (9 to 15 digits), leftmost and non-overlapping per kind.

*Information-theoretic sanitisation* removes what gives a protected entity away
after the entity itself is gone. The entities are the values of the base findings. With
``N`` words in the corpus, of which ``n(t)`` are the term t, ``n(e)`` findings of
e, and ``n(e, t)`` of these with t in their window (64 code points of the same
line on either side, up to the next finding of the kind), the information that t
gives about e is PMI(e; t) = log2(p(e | t) / p(e)) with p(e | t) = n(e, t) / n(t)
and p(e) = n(e) / N. It cannot exceed that of e itself, IC(e) = -log2 p(e). A term that
reveals more than a share ``disclosure`` of IC(e) may not stand beside e: in
a text where it lies in a window of e, every occurrence of it is
*generalised* to a mark, or *removed* if it gives e away for certain (PMI = IC). So a name that
is written beside one address all over the corpus goes with the address,
while common words stay. At least ``windows`` different windows must hold the pair:
copies of one text are no evidence.

Only DataFrame functions are used. Patterns are written so that they need linear
time (possessive runs; a run is tried from its beginning only). Positions are sums
over the gaps between matches, in chunks. Equal windows combine before
their terms are taken apart, on the map side, so an entity in a third of all texts is
few rows; word counts combine there too. Texts are joined by their digest, once each.

Defined results: null text has no findings (its digest is that of the empty
string) and stays null; texts of any length are read whole; repeated rows give equal
results; a row without base findings is left alone; spans of different kinds
may overlap; other columns pass through (``find`` replaces ``_base`` and ``_spans``); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import shielded, table, written

KINDS = ("email", "ip", "card", "phone", "term")
#: Matches begin where a run begins, or where the match before ended.
_PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_WORD = r"[\p{L}\p{M}]+"
#: Code points of a window on either side.
WINDOW = 64
_CHUNK = 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def _starts(gaps: str, matches: str) -> Column:
    """Start of every match in code points: sums of the gaps and matches before it, chunk by chunk."""
    steps = f"zip_with(slice({gaps}, 1, size({matches})), {matches}, (g, m) -> named_struct('g', char_length(g), 'm', char_length(m)))"
    return F.expr(f"""
      CASE WHEN size({matches}) = 0 THEN cast(array() AS array<int>) ELSE
        transform(array({steps}), s -> transform(array(aggregate(
            transform(sequence(0, (size(s) - 1) div {_CHUNK}), k -> aggregate(slice(s, k * {_CHUNK} + 1, {_CHUNK}), 0, (a, x) -> a + x.g + x.m)),
            array(0), (a, x) -> array_append(a, element_at(a, -1) + x))),
          base -> transform(s, (x, i) -> get(base, i div {_CHUNK})
            + aggregate(slice(s, (i div {_CHUNK}) * {_CHUNK} + 1, i % {_CHUNK}), 0, (a, y) -> a + y.g + y.m) + x.g))[0])[0] END""")


def _luhn(digits: str) -> str:
    digit = f"cast(substring({digits}, char_length({digits}) - i, 1) AS int)"
    return (f"(aggregate(sequence(0, char_length({digits}) - 1), 0, (a, i) -> a + CASE WHEN i % 2 = 0 THEN {digit} "
            f"WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END) % 10 = 0)")


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
#: Whether a match ``m`` counts, and its value as an entity.
_VALID = (
    "true",
    r"forall(split(m, '[.]'), p -> char_length(ltrim('0', p)) <= 3 AND cast(concat('0', right(ltrim('0', p), 3)) AS int) <= 255)",
    f"CASE WHEN char_length({_DIGITS}) BETWEEN 12 AND 19 THEN {_luhn(_DIGITS)} ELSE false END",
    f"char_length({_DIGITS}) BETWEEN 9 AND 15",
)
_VALUE = (f"translate(m, '{_UPPER}', '{_UPPER.lower()}')", "m", _DIGITS, _DIGITS)


def _window(gap: str, left: bool) -> str:
    """Words of a gap that lie whole in the window, as text: its part in the line, without a word that is cut."""
    n = WINDOW + 1
    near = f"right({gap}, {n})" if left else f"left({gap}, {n})"
    line = f"substring_index({near}, '\\n', {-1 if left else 1})"
    cut = r"^[\\p{L}\\p{M}]+" if left else r"[\\p{L}\\p{M}]+$"
    return f"CASE WHEN char_length({line}) = {n} THEN regexp_replace({line}, '{cut}', '') ELSE {line} END"


def _base(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``_base``: the base findings (start, kind, end, entity, words on the left, words on the right)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    guards = (t.contains("@"), t.rlike("[0-9][0-9.]"), t.rlike("[0-9][ -]?[0-9]"), t.contains("+"))
    kinds = []
    for k, (pattern, guard) in enumerate(zip(_PATTERNS, guards, strict=True)):
        none = F.array().cast("array<string>")
        rows = rows.withColumns({f"_m{k}": F.when(guard, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none)})
        rows = rows.withColumns({f"_g{k}": F.when(F.size(f"_m{k}") > 0, F.split(t, pattern, -1)).otherwise(none)})
        rows = rows.withColumns({f"_s{k}": _starts(f"_g{k}", f"_m{k}")})
        rows = rows.withColumns({f"_f{k}": F.expr(f"""
            transform(filter(transform(_m{k}, (m, i) -> named_struct('m', m, 'i', i)), x -> transform(array(x.m), m -> {_VALID[k]})[0]),
              x -> transform(array(x.m), m -> named_struct('start', get(_s{k}, x.i), 'kind', {k}, 'end', get(_s{k}, x.i) + char_length(m),
                'entity', sha2(concat('{KINDS[k]}:', {_VALUE[k]}), 256),
                'before', {_window(f"get(_g{k}, x.i)", True)}, 'after', {_window(f"get(_g{k}, x.i + 1)", False)}))[0])""")})
        kinds.append(f"_f{k}")
    rows = rows.withColumn("_base", F.array_sort(F.concat(*kinds)))
    return rows.drop(*(f"_{c}{k}" for k in range(len(_PATTERNS)) for c in "mgsf"))


def _terms(c: Column) -> Column:
    return F.regexp_extract_all(_lower(c), F.lit(_WORD), F.lit(0))


def disclosing(found: DataFrame, corpus: DataFrame, text: str, disclosure: float, windows: int) -> tuple[DataFrame, DataFrame]:
    """(entity, term, ``sure``) of the terms that give an entity away, and the different windows of the corpus."""
    spans = found.where(F.size("_base") > 0).select(F.explode("_base").alias("s"))
    both = F.concat("s.before", F.lit(" \n "), "s.after")
    seen = (spans.select("s.entity", F.md5(both).alias("window"), both.alias("words"))
            .groupBy("entity", "window").agg(F.count("*").alias("m"), F.min("words").alias("words")))
    seen = written(seen.select("entity", "window", "m", F.array_distinct(_terms(F.col("words"))).alias("terms")))
    pairs = (seen.select("entity", "m", F.explode("terms").alias("term")).groupBy("entity", "term")
             .agg(F.sum("m").alias("n_et"), F.count("*").alias("support")).where(F.col("support") >= windows))
    words = written(corpus.select(F.explode(_terms(F.col(text).cast("string"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t")))
    total = words.select(F.sum("n_t")).scalar()
    entities = seen.groupBy("entity").agg(F.sum("m").alias("n_e"))
    rated = pairs.join(words, "term").join(entities, "entity")
    known = F.least(F.lit(1.0), F.col("n_et") / F.col("n_t"))
    content = -F.log2(F.least(F.lit(1.0), F.col("n_e") / total))
    shown = content + F.log2(known)
    return rated.where((content > 0) & (shown >= disclosure * content)).select("entity", "term", (F.col("n_et") >= F.col("n_t")).alias("sure")), seen


def find(docs: DataFrame, text: str = "text", disclosure: float = 0.9, windows: int = 3, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: arrays of (start, kind, end, sure), base findings and all, by start, then kind.

    ``kind`` counts in ``KINDS``; ``sure`` tells terms to remove. Without ``keep_text`` the text is left out.
    """
    docs, back = shielded(docs.drop("_base", "_spans"), {"_key", "_text", "_terms"})
    rows = _base(docs, text)
    has = F.size("_base") > 0
    rows = rows.withColumns({"_key": F.when(has, F.md5(F.col(text))), "_text": F.when(has, F.col(text).cast("string"))})
    found = written(rows if keep_text else rows.drop(text))
    given, seen = disclosing(found, docs, text, disclosure, windows)
    # The windows that hold a term with an entity it reveals, then the texts with such a window.
    marked = (seen.select("entity", "window", F.explode("terms").alias("term")).join(given, ["entity", "term"])
              .groupBy("entity", "window").agg(F.collect_list(F.struct("term", "sure")).alias("given")))
    places = found.where(has).dropDuplicates(["_key"]).select("_key", F.explode("_base").alias("s"))
    places = places.select("_key", "s.entity", F.md5(F.concat("s.before", F.lit(" \n "), "s.after")).alias("window"))
    hit = places.join(marked, ["entity", "window"]).select("_key", F.explode("given").alias("g"))
    hit = written(hit.groupBy("_key", "g.term").agg(F.max("g.sure").alias("sure")))
    texts = found.where(has).dropDuplicates(["_key"]).select("_key", "_text").join(hit.select("_key").distinct(), "_key", "left_semi")
    texts = texts.withColumns({"_w": F.regexp_extract_all("_text", F.lit(_WORD), F.lit(0)), "_g": F.split("_text", _WORD, -1)})
    texts = texts.select("_key", F.explode(F.arrays_zip(_starts("_g", "_w").alias("s"), F.col("_w").alias("w"))).alias("x"))
    texts = texts.select("_key", F.col("x.s").alias("start"), _lower(F.col("x.w")).alias("term"), (F.col("x.s") + F.char_length("x.w")).alias("end"))
    terms = (texts.join(hit, ["_key", "term"]).groupBy("_key")
             .agg(F.collect_list(F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end", "sure")).alias("_terms")))
    base = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(False).alias("sure")))
    found = found.withColumn("_base", base)
    with_terms = found.where(has).join(terms, "_key", "left")
    nothing = F.array().cast(terms.schema["_terms"].dataType)
    out = found.where(~has).withColumn("_terms", nothing).unionByName(with_terms)
    out = out.withColumn("_spans", F.array_sort(F.concat("_base", F.coalesce("_terms", nothing))))
    return out.select(*(c for c in docs.columns if keep_text or c != text), "_base", "_spans").withColumnsRenamed(back)


def sanitise(docs: DataFrame, text: str = "text", disclosure: float = 0.9, windows: int = 3) -> DataFrame:
    """``docs`` with ``text`` cleaned: base findings become ``[EMAIL]``, ``[IP]``, ``[CARD]``, ``[PHONE]``; terms that
    reveal them become ``[TERM]`` or go. Of spans that overlap, the first one's mark stands for all."""
    docs, back = shielded(docs, {"_base", "_spans"})
    rows = find(docs, text, disclosure, windows)
    marks = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    cleaned = F.expr(f"""
      transform(array(split(`{text}`, '')), chars -> transform(array(aggregate(_spans, named_struct('at', 0, 'parts', cast(array() AS array<string>)),
          (a, s) -> CASE WHEN s.start >= a.at THEN named_struct('at', s.end, 'parts', array_append(a.parts, concat(
              array_join(slice(chars, a.at + 1, s.start - a.at), ''), CASE WHEN s.sure THEN '' ELSE element_at(array({marks}), s.kind + 1) END)))
            ELSE named_struct('at', greatest(a.at, s.end), 'parts', a.parts) END)),
        r -> concat(array_join(r.parts, ''), array_join(slice(chars, r.at + 1, size(chars)), '')))[0])[0]""")
    return rows.withColumn(text, F.when(F.size("_spans") > 0, cleaned).otherwise(F.col(text))).select(*docs.columns).withColumnsRenamed(back)


def span_text(spans: str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_personal_data(spark, sf_dir) -> DataFrame:
    rows = find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    counts = [F.expr(f"size(filter(_base, s -> s.kind = {k}))").cast("long").alias(f"n_{KINDS[k]}") for k in range(len(_PATTERNS))]
    return rows.select("doc_id", *counts, F.sha2(span_text("_base"), 256).alias("base_sha256"), span_text("_spans").alias("spans"))


OP12_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS (
  SELECT doc_id, kind, name, regexp_extract_all(text, pattern) AS m, regexp_split_to_array(text, pattern) AS g FROM docs,
    (VALUES (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
      (2, 'card', '[0-9]([\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')) AS p(kind, name, pattern)),
matches AS (
  SELECT doc_id, kind, name, m[i] AS m, g[i] AS before, g[i + 1] AS after, regexp_replace(m[i], '[^0-9]', '', 'g') AS digits,
    coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM raw)),
base AS (
  SELECT doc_id, kind, name, CAST(start AS BIGINT) AS start, CAST(start + length(m) AS BIGINT) AS stop,
    name || ':' || CASE WHEN kind = 0 THEN translate(m, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') WHEN kind = 1 THEN m ELSE digits END AS entity,
    string_split(right(before, 65), chr(10))[-1] AS lt, string_split(left(after, 65), chr(10))[1] AS rt
  FROM matches WHERE CASE kind
    WHEN 0 THEN true
    WHEN 1 THEN len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || ltrim(p, '0')[1:3] AS INT) > 255)) = 0
    WHEN 2 THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(0, length(digits)), lambda i:
      CASE WHEN i % 2 = 0 THEN CAST(digits[length(digits) - i] AS INT)
      ELSE 2 * CAST(digits[length(digits) - i] AS INT) - CASE WHEN CAST(digits[length(digits) - i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
    ELSE length(digits) BETWEEN 9 AND 15 END),
near AS (
  SELECT doc_id, entity, CASE WHEN length(lt) = 65 THEN regexp_replace(lt, '^[\p{L}\p{M}]+', '') ELSE lt END || chr(10)
    || CASE WHEN length(rt) = 65 THEN regexp_replace(rt, '[\p{L}\p{M}]+$', '') ELSE rt END AS ctx FROM base),
terms AS (
  SELECT doc_id, entity, ctx, unnest(list_distinct(regexp_extract_all(
    translate(ctx, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\p{L}\p{M}]+'))) AS term FROM near),
pairs AS (SELECT entity, term, count(*) AS n_et FROM terms GROUP BY ALL HAVING count(DISTINCT ctx) >= 3),
words AS (
  SELECT term, count(*) AS n_t FROM (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\p{L}\p{M}]+')) AS term FROM docs) GROUP BY term),
ents AS (SELECT entity, count(*) AS n_e FROM base GROUP BY entity),
given AS (
  SELECT entity, term FROM (SELECT p.*, w.n_t, -log2(least(1.0, n_e / (SELECT sum(n_t) FROM words))) AS content
    FROM pairs p JOIN words w USING (term) JOIN ents e USING (entity))
  WHERE content > 0 AND content + log2(least(1.0, n_et / n_t)) >= 0.9 * content),
hit AS (SELECT DISTINCT doc_id, term FROM terms JOIN given USING (entity, term)),
toks AS (
  SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{M}]+') AS m, regexp_split_to_array(text, '[\p{L}\p{M}]+') AS g
  FROM docs WHERE doc_id IN (SELECT doc_id FROM hit)),
found AS (
  SELECT doc_id, translate(m[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, length(m[i]) AS size,
    coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM toks)),
spans AS (
  SELECT doc_id, kind, name, start, stop FROM base
  UNION ALL SELECT doc_id, 4, 'term', CAST(start AS BIGINT), CAST(start + size AS BIGINT) FROM found JOIN hit USING (doc_id, term)),
joined AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card,
    count(*) FILTER (kind = 3) AS n_phone,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 4) AS base,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""
