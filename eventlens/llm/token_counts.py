"""Token counts by a two-tier lookup on the map side; no pre-token is shuffled.

Tier one is a broadcast table {chunk: number of tokens} of the most frequent
chunks of all documents: every task counts its chunks in a bounded table and
sends the most frequent ones, whose counts are added up. It holds at most
``frequent`` entries of at most 64 characters, so its size has a fixed bound.
Tier two is a cache in each Python worker that encodes what tier one misses.
Neither tier changes a count: both hold what the tokenizer gives.

Defined results: null or empty text has 0 bytes and 0 tokens; very long texts are
counted whole; repeated rows and null ids are counted row by row; other columns,
also of clashing names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import bpe
from eventlens.llm.common import per_task, small_batches, table


def frequent_lengths(docs: DataFrame, text: str, tokenizer: str, frequent: int) -> dict[str, int]:
    """Token lengths of the most frequent chunks of all texts."""
    def tally(batches):
        seen = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(c for c in bpe.chunks(t or "")[1] if 0 < len(c) <= 64)
            if len(seen) > 50 * frequent:
                seen = Counter(dict(seen.most_common(10 * frequent)))
        top = seen.most_common(frequent)
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                                             names=["chunk", "n"])

    top = (docs.select(F.col(text).cast("string")).mapInArrow(per_task(tally), "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "chunk").limit(frequent).collect())
    enc = bpe.encoder(tokenizer)
    return {r.chunk: len(enc.chunk(" " + r.chunk)) for r in top}


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k.json",
                 limit: int = 1024, frequent: int = 20_000) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    small_batches(spark)
    lengths = spark.sparkContext.broadcast(frequent_lengths(docs, text, tokenizer, frequent))

    def counted(batches):
        enc = bpe.encoder(tokenizer)
        cache = bpe.ChunkCache(lambda c: len(enc.chunk(c)), lengths.value)
        for batch in batches:
            n = [bpe.count(enc, cache, t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long"))
    out = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"), size.alias("n_bytes"))
    return (out.mapInArrow(per_task(counted), f"id {kind}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def op2_token_counts(spark, sf_dir) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
