"""Exact top-k inner-product search by the threshold algorithm on sorted lists.

The vectors are written once and dealt into shards of at most about
``shard_rows`` rows by a hash of the row, whatever its id. In a shard every dimension has a list of its rows sorted by value. A
query walks the lists of its non-zero dimensions from the end that gives the
larger products, in growing steps of depth; every row that appears is scored in
full (random access). What has not appeared by a depth cannot score more than
the sum of the products at that depth, so the walk stops as soon as the k-th
best score is above this bound; on equality it goes on, since an unseen row
with a smaller id would win the tie. A shard gives at most k rows a query, and
the k best of all shards are the exact result.

Queries travel in blocks to the shards: work is queries times shards, the
stated query set against all rows. A shard goes to its task once, sorted before the blocks that it
answers one by one. A shard and a block of queries have bounded size; nothing is broadcast or collected.

Components are ``floor(scale * x)`` as integers. Defined results: vectors that
are null, empty, or hold null or non-finite components take no part, as query
or candidate; rows of null id neither; vectors meet only those of equal length;
repeated ids are rows of their own, and a query skips its own row only; ties
go to the smaller id, rows of one id in turn; a score outside the range of a long is held at its end;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import per_task, small_batches, table, written

#: Fewer rows are not worth a shard of their own.
LEAST_ROWS = 1024
#: Integers up to this sum of products are exact in doubles.
_EXACT = 1 << 52


class SortedLists:
    """A shard's rows and, by dimension, their order by value."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.numbers, self.ids, self.rows = numbers, ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(rows.T, self.order, axis=1)

    def search(self, number: int, q: np.ndarray, k: int, first: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, by the threshold algorithm."""
        n, dims = self.ids.size, np.flatnonzero(q)
        seen = self.numbers == number
        up = q[dims] < 0  # a negative weight walks from the smallest value
        ids, scores = np.empty(0, np.int64), np.empty(0, self.rows.dtype)
        depth, step = 0, first
        if not dims.size:  # every score is 0: nothing to walk
            best = np.sort(self.ids[~seen])[:k]
            return best, np.zeros(best.size, self.rows.dtype)
        while depth < n:
            to = min(n, depth + step)
            lists = np.concatenate([self.order[dims[up], depth:to].ravel(), self.order[dims[~up], n - to:n - depth].ravel()])
            fresh = np.zeros(n, bool)
            fresh[lists] = True
            fresh &= ~seen
            seen |= fresh
            at = np.flatnonzero(fresh)
            ids = np.concatenate([ids, self.ids[at]])
            scores = np.concatenate([scores, self.rows[at] @ q])
            keep = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[keep], scores[keep]
            depth, step = to, step * 2
            edge = np.where(up, self.values[dims, to - 1], self.values[dims, n - to])
            if ids.size == k and scores[-1] > (edge * q[dims]).sum():
                break
        return ids, scores


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, scale: float = 256.0,
          shard_rows: int = 32768, block_rows: int = 512) -> DataFrame:
    """Per query (rows where ``is_query`` holds) its k best rows: ``query_id``, ``rank``, id, ``score``."""
    spark = vectors.sparkSession
    small_batches(spark)
    x = F.col(vector)
    usable = (x.isNotNull() & (F.size(x) > 0) & F.col(id_col).isNotNull()
              & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))))
    rows = (vectors.where(F.coalesce(usable, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), F.size(x).alias("dim"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("v")))
    # Rows are numbered in a written table, so that a task that runs again deals them alike.
    rows = written(rows.withColumn("no", F.monotonically_increasing_id()))
    n, asked = rows.agg(F.count("*"), F.count_if("q")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, math.ceil(n / shard_rows), min(parts, math.ceil(n / LEAST_ROWS)))

    def grouped(df: DataFrame, parts: int) -> DataFrame:
        """(dim, part, list of rows): groups of bounded size."""
        part = F.pmod(F.xxhash64("no"), F.lit(parts)).cast("int").alias("part")
        return df.groupBy("dim", part).agg(F.collect_list(F.struct("no", "id", "v")).alias("rows"))

    data = grouped(rows, shards).select("dim", F.col("part").alias("shard"), F.lit(0).alias("side"), "rows")
    queries = grouped(rows.where("q"), max(1, math.ceil(asked / block_rows)))
    sent = queries.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("side"), "rows")

    def unpack(cell: pa.ListScalar, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        numbers, ids, flat = (cell.values.field(i) for i in range(3))
        return numbers.to_numpy(), ids.to_numpy(), flat.flatten().to_numpy().reshape(-1, dim)

    def integers(m: np.ndarray) -> np.ndarray:
        return np.array([[int(y) for y in r] for r in m], object).reshape(m.shape)

    def search(batches):
        held = lists = exact = None
        for b in batches:
            for i in range(b.num_rows):
                dim, shard, side = (b.column(j)[i].as_py() for j in range(3))
                if side == 0:
                    numbers, ids, m = unpack(b.column(3)[i], dim)
                    order = np.lexsort((numbers, ids))
                    held, lists, exact = (dim, shard), SortedLists(numbers[order], ids[order], m[order]), None
                    top = np.abs(m).max(initial=1)
                    continue
                if held != (dim, shard):  # no rows of this length in the shard
                    continue
                out = []
                for number, qid, q in zip(*unpack(b.column(3)[i], dim), strict=True):
                    use = lists
                    if np.abs(q).max() * top * dim >= _EXACT:  # beyond exact doubles: Python integers
                        exact = exact or SortedLists(lists.numbers, lists.ids, integers(lists.rows))
                        use, q = exact, integers(q[None])[0]
                    ids, scores = use.search(number, q, k)
                    out += [(number, qid, j, max(-(1 << 63), min((1 << 63) - 1, int(s)))) for j, s in zip(ids, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], pa.int64()) for j in range(4)], names=["no", "query_id", "id", "score"])

    met = data.unionByName(sent).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "side")
    best = met.mapInArrow(per_task(search), "no long, query_id long, id long, score long")
    w = Window.partitionBy("no").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def op5_topk_search(spark, sf_dir) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
