"""Cost-balanced packing of documents into token sequences; no shuffle.

Each task packs blocks of its own documents. Whole pieces of ``size`` tokens
leave as sequences of their own. The rests are sorted from long to short (equal
ones as they came); each goes to the sequence of the lowest estimated cost
(``linear`` a token plus ``quadratic`` a squared piece length, which is what
attention inside the piece costs; of equal costs, the first) that has room for all of it. Only if none has,
the rest is cut at the room of the cheapest. So every sequence but the tail
of a block is full; the tail (under ``size`` tokens) goes into sequences of
decreasing powers of two, which take no padding. Costs balance within a block.

A block's size is bounded in tokens, so memory is bounded by it and by the
longest document. Sequence ids are the partition number and a running number
there; a task that runs again gives the same ids.

Defined results: null or empty text is one end token; a very long text is one document, whole in
memory; repeated rows are packed one by one; a null id is kept as null; other columns, also of clashing
names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import bpe
from eventlens.llm.common import per_task, small_batches, table


class Rooms:
    """Sequences by their room: a heap by cost for every room, and the cheapest of every range of rooms."""

    NONE = (float("inf"), -1, 0)

    def __init__(self, size: int):
        self.half = 1 << size.bit_length()
        self.heaps: dict[int, list[tuple[float, int, int]]] = {}
        self.best = [self.NONE] * (2 * self.half)

    def _renew(self, room: int) -> None:
        at = self.half + room
        self.best[at] = self.heaps[room][0] if self.heaps[room] else self.NONE
        while at > 1:
            at >>= 1
            self.best[at] = min(self.best[2 * at], self.best[2 * at + 1])

    def put(self, cost: float, s: int, room: int) -> None:
        heapq.heappush(self.heaps.setdefault(room, []), (cost, s, room))
        self._renew(room)

    def take(self, least: int) -> tuple[float, int, int] | None:
        """The cheapest sequence with a room of ``least`` or more; it leaves."""
        out, lo, hi = self.NONE, self.half + least, 2 * self.half
        while lo < hi:
            if lo & 1:
                out, lo = min(out, self.best[lo]), lo + 1
            lo, hi = lo >> 1, hi >> 1
        if out[1] < 0:
            return None
        heapq.heappop(self.heaps[out[2]])
        self._renew(out[2])
        return out


def balance(lengths: list[int], size: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start in the piece, length) for rests shorter than ``size``.

    All sequences are full but the last, which hold the tail in powers of two.
    """
    full = sum(lengths) // size
    held: list[list[tuple[int, int, int]]] = [[] for _ in range(full)]
    rooms = Rooms(size)
    if full:
        rooms.heaps[size] = [(0.0, s, size) for s in range(full)]
        rooms._renew(size)
    tail: list[tuple[int, int, int]] = []

    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[item]
        while left:
            found = rooms.take(left) or rooms.take(1)
            if not found:
                tail.append((item, start, left))
                break
            cost, s, room = found
            n = min(left, room)
            held[s].append((item, start, n))
            if room > n:
                rooms.put(cost + linear * n + quadratic * n * n, s, room - n)
            start, left = start + n, left - n
    rest, free = sum(n for *_, n in tail), 0
    for item, start, n in tail:
        while n:
            if not free:
                free = 1 << (rest.bit_length() - 1)
                held.append([])
            take = min(n, free)
            held[-1].append((item, start, take))
            start, n, free, rest = start + take, n - take, free - take, rest - take
    return held


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k.json", size: int = 1024,
         end_id: int = 0, linear: float = 1.0, quadratic: float = 1 / 1024, block_tokens: int = 2_000_000, with_ids: bool = True) -> DataFrame:
    """Per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids`` (binary)."""
    small_batches(docs.sparkSession)
    end = bpe.packed([end_id])
    kind = docs.schema[id_col].dataType.simpleString()

    def packed(batches):
        enc = bpe.encoder(tokenizer)
        cache = bpe.ChunkCache(lambda c: bpe.packed(enc.chunk(c)))
        base, made = TaskContext.get().partitionId() << 40, 0
        block, held, id_type = [], 0, None

        def emit(block):
            nonlocal made
            rows, rests = [], []
            for key, ids in block:
                n = len(ids) // 4
                whole = n - n % size
                for start in range(0, whole, size):
                    rows.append((key, ids, start, size, n, base + made, 0))
                    made += 1
                if n > whole:
                    rests.append((key, ids, whole, n))
            for seq in balance([n - whole for _, _, whole, n in rests], size, linear, quadratic):
                offset = 0
                for item, start, length in seq:
                    key, ids, whole, n = rests[item]
                    rows.append((key, ids, whole + start, length, n, base + made, offset))
                    offset += length
                made += 1
            for at in range(0, len(rows), 4096):
                part = rows[at:at + 4096]
                cut = [ids[4 * s:4 * (s + n)] for _, ids, s, n, *_ in part]
                cols = [pa.array([r[0] for r in part], id_type), *(pa.array([r[i] for r in part], pa.int64()) for i in (2, 3)),
                        pa.array([zlib.crc32(x) for x in cut], pa.int64()), *(pa.array([r[i] for r in part], pa.int64()) for i in (4, 5, 6)),
                        *([pa.array(cut, pa.binary())] if with_ids else [])]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][:len(cols)])

        for batch in batches:
            id_type = batch.column(0).type
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = (bpe.ids_bytes(enc, cache, t) if t else b"") + end
                block.append((key, ids))
                held += len(ids) // 4
                if held >= block_tokens:
                    yield from emit(block)
                    block, held = [], 0
        if block:
            yield from emit(block)

    out = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids binary" if with_ids else ""
    return out.mapInArrow(per_task(packed), schema).withColumnRenamed("id", id_col)


def op3_packing(spark, sf_dir) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
