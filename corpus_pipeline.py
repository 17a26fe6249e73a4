"""Corpus pipeline: language ID, line dedup, near-duplicates, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents``. Rows that a stage keeps keep all columns;
``n_chars`` follows the text.

Defined results: documents without a letter (or text) leave with the first
stage; a document whose every line went as boilerplate leaves with the second,
while one that was empty before stays. Rows of a null id are documents like
others: they keep all their lines (and lend none), and as near duplicates they
give way to rows with an id. Rows of one id are judged by their texts; of equal
rows one stays. Other columns, also of clashing names, pass through to the last
stage. The rest is as the operators say. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import decontaminate, language_id, line_dedup, near_dup, packing
from eventlens.llm.common import table, written

#: Least score of the predicted language; clean prose of a known language is far above.
MIN_SCORE = 0.1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language the classifier can tell."""
    model = language_id.fit(docs)
    out = language_id.identify(docs, model)
    return out.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that stand on many sites, but for their first document."""
    out = line_dedup.line_dedup(docs)
    out = out.where((F.col("_n_removed") == 0) | (F.trim("text") != ""))
    changed = F.when(F.col("_n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed.cast("long")).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five words, similarity 0.8)."""
    return near_dup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with passages of the benchmark, or with a whole item of few words."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens; one row a piece."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The stages are not expressible in SQL (a trained classifier, a tokenizer); tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a written table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
