"""Shared helpers: table access, shared-folder tables, vectorized word hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from eventlens.session import materialized

#: Text bytes that a task turns into arrays at a time (one longer text is taken alone).
SLICE_BYTES = 1 << 20
#: Rows and bytes of an Arrow batch: bounds what a Python worker holds of long texts.
ARROW_ROWS, ARROW_BYTES = 512, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows and bytes (one longer row is a batch): texts have no length limit. All operators
    ask for the same, so it does not matter which one's plan was built last."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives the loss of executors."""
    return materialized(df)


def shielded(df: DataFrame, names: set[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns that bear an operator's own names renamed, and how to rename them back."""
    away = {c: f"{c}__{i}__own" for i, c in enumerate(df.columns) if c.lower() in names}
    return df.withColumnsRenamed(away), {v: k for k, v in away.items()}


def release() -> None:
    """Gives freed memory back to the system."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    pa.default_memory_pool().release_unused()
    if trim:
        trim(0)


def per_task(function: Callable) -> Callable:
    """A batch function that, when its task ends, gives freed memory back to the
    system: Spark keeps Python workers for later tasks, beside a growing heap."""
    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()
    return run


# --- words ------------------------------------------------------------------
# A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Its 64-bit
# hash is a polynomial over random byte values, taken from one prefix sum over
# the buffer, then mixed; words of a whole batch cost a few array passes.

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _VALUES.copy()
_LOWER[0x41:0x5B] = _VALUES[0x61:0x7B]
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("up", np.empty(0)).size < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        tables = np.cumprod(up), np.cumprod(down)
        if size > 16 * SLICE_BYTES:
            return tables  # for one very long text only; not kept
        _powers["up"], _powers["down"] = tables
    return _powers["up"], _powers["down"]


class Words(NamedTuple):
    """Words of the texts of one slice: byte ranges, hashes, and each text's word range."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i]:self.bounds[i + 1]]

    def texts(self, i: int) -> list[bytes]:
        lo, hi = self.bounds[i], self.bounds[i + 1]
        raw = self.data
        return [raw[s:e].tobytes() for s, e in zip(self.starts[lo:hi].tolist(), self.ends[lo:hi].tolist(), strict=True)]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls read as empty."""
    return buffers_of(pc.fill_null(texts.cast(pa.large_string()), ""))


def buffers_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large string or binary array without nulls."""
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of every text; ``lower`` hashes A-Z as a-z."""
    data, off = buffers(texts)
    n = data.size
    if n == 0:
        z = np.empty(0, np.int64)
        return Words(data, z, z, np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    space = _SPACE[data]
    first, last = np.empty(n, bool), np.empty(n, bool)
    first[0], last[-1] = True, True
    first[1:], last[:-1] = space[:-1], space[1:]
    first[off[:-1][off[:-1] < n]] = True
    last[off[1:][off[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(~space & first), np.flatnonzero(~space & last) + 1
    up, down = _power_tables(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((_LOWER if lower else _VALUES)[data] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, off))


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of the batch whose texts have at most SLICE_BYTES together (or one text)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < batch.num_rows:
        yield batch.slice(at)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of runs of k words (fewer words: the whole sequence as one)."""
    n = hashes.size
    if n == 0:
        return hashes
    if n < k:
        return combine([hashes[i:i + 1] for i in range(n)])
    return np.unique(combine([hashes[i:n - k + 1 + i] for i in range(k)]))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several, in order; their number counts."""
    out = np.full(parts[0].size, len(parts) * 0x632BE59BD9B4E019 & ((1 << 64) - 1), dtype=np.uint64)
    for p in parts:
        out = mix((out ^ p) * np.uint64(0x9E3779B97F4A7C15))
    return out
