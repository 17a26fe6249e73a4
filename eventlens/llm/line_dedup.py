"""Cross-site line dedup: distinct-site spread by HyperLogLog, exact near the threshold.

A line (trimmed of blanks, not empty) is boilerplate if it occurs on at least
``min_sites`` distinct sites. Per line hash, a HyperLogLog sketch of the sites
is merged by aggregation, beside the smallest document id. Lines whose estimate
is clearly over the threshold are boilerplate, lines clearly below are not;
between, the distinct sites are counted exactly. Boilerplate stays in the
document with the smallest id that has it and goes everywhere else, so no text
leaves the corpus.

Only DataFrame functions are used. Lines travel as 96-bit hashes; the sketches
combine on the map side, so a line that a third of all documents hold is one
row a task before the shuffle. Only positions of removed lines are joined back
to the texts, which are shuffled once.

Defined results: null text stays null with 0 lines; very long texts are split whole; a null site counts as one
site; blank lines are never removed; a line repeated inside a document is
judged once and removed at each place; repeated ids count as one document (a
line is removed from each of its rows or none); rows of null id keep all lines
and lend none; other columns pass through (``_n_lines`` and ``_n_removed`` are
replaced); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import shielded, table, written

#: log2 of the sketch's registers; the relative error of an estimate is about 1.04 / 2^(LG_K / 2).
LG_K = 10


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = 10) -> DataFrame:
    """``docs`` with ``text`` cleaned, and the further columns ``_n_lines`` and ``_n_removed``."""
    key = ["_h1", "_h2"]
    docs, back = shielded(docs.drop("_n_lines", "_n_removed"), {"_text_hash", "_gone_id", "_gone_hash", "_gone", "_lines", "_kept"})
    # A row is known by its id and the hash of its text: rows of one id may differ.
    rows = docs.withColumn("_text_hash", F.xxhash64(F.col(text)))
    lines = (rows.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("_id"), "_text_hash", F.coalesce(F.col(site).cast("string"), F.lit("")).alias("_site"),
                     F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_line"))
             .withColumn("_line", F.trim("_line")).where("_line != ''")
             .select("_id", "_text_hash", "_site", "_pos", F.xxhash64("_line").alias("_h1"), F.hash("_line").alias("_h2")))
    # Six standard errors of the sketch, and at least two sites, on either side.
    band = max(2.0, 6 * 1.04 / 2 ** (LG_K / 2) * min_sites)
    spread = (lines.groupBy(*key).agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LG_K))).alias("_sites"), F.min("_id").alias("_first"))
              .where(F.col("_sites") >= min_sites - band))
    # Few lines are left; their places serve both the exact counts and the removal.
    places = written(lines.join(spread, key))
    is_near = F.col("_sites") <= min_sites + band
    exact = (places.where(is_near).select(*key, "_site").distinct().groupBy(*key).agg(F.count("*").alias("_n"))
             .where(F.col("_n") >= min_sites).select(*key))
    elsewhere = places.where(F.col("_id") != F.col("_first"))
    sure = elsewhere.where(~is_near).select("_id", "_text_hash", "_pos")
    found = elsewhere.where(is_near).join(exact, key, "left_semi").select("_id", "_text_hash", "_pos")
    gone = (sure.unionByName(found).groupBy(F.col("_id").alias("_gone_id"), F.col("_text_hash").alias("_gone_hash"))
            .agg(F.collect_set("_pos").alias("_gone")))
    joined = rows.join(gone, (F.col(id_col) == F.col("_gone_id")) & (F.col("_text_hash") == F.col("_gone_hash")), "left")
    split = F.split(F.col(text), "\n")
    # Kept positions by set difference: linear in the number of lines.
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    cleaned = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform("_kept", lambda i: F.get(F.col("_lines"), i)), "\n"))
    return (joined.withColumn("_lines", split).withColumn("_kept", kept)
            .withColumn("_n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size("_lines")).cast("long"))
            .withColumn("_n_removed", F.coalesce(F.col("_n_lines") - F.size("_kept"), F.lit(0)).cast("long"))
            .withColumn(text, cleaned)
            .drop("_text_hash", "_gone_id", "_gone_hash", "_gone", "_lines", "_kept").withColumnsRenamed(back))


def op1_line_dedup(spark, sf_dir) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))


OP1_SQL = """
WITH rows AS (SELECT doc_id, coalesce(source, '') AS site, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, site, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM rows),
spread AS (
  SELECT trim(line, ' ') AS line, min(doc_id) AS first FROM lines WHERE trim(line, ' ') <> ''
  GROUP BY 1 HAVING count(DISTINCT site) >= 10),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(s.line) AS n_removed,
    coalesce(string_agg(CASE WHEN s.line IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') AS text
  FROM lines l LEFT JOIN spread s ON trim(l.line, ' ') = s.line AND l.doc_id <> s.first GROUP BY 1)
SELECT r.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
  CASE WHEN r.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS text_sha256
FROM rows r LEFT JOIN kept k ON r.doc_id = k.doc_id
"""
