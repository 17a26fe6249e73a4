"""Hashes used for visitor bitmaps and deterministic salting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.functions.time import to_col

# Fixed values of the visitor bitmap (must stay equal for equal results):
# polynomial seed 25, bitmap of 2^29 bits.
UV_HASH_SEED = 25
UV_BITMAP_BITS = 29


def poly_hash(c, seed: int = UV_HASH_SEED, bits: int = UV_BITMAP_BITS) -> Column:
    """h = (h * seed + code(char)) over the characters of str(c), kept mod 2^bits.

    The mask is applied inside the fold: equal modulo 2^bits to the
    wrapping 64-bit form, and it never overflows under ANSI mode.
    """
    mask = (1 << bits) - 1
    s = to_col(c).cast("string")
    return F.aggregate(
        F.split(s, ""),
        F.lit(0).cast("bigint"),
        lambda acc, ch: ((acc * seed + F.ascii(ch)).bitwiseAND(F.lit(mask).cast("bigint"))),
    )


def salt(c, n: int) -> Column:
    """Deterministic salt in [0, n): stable across task retries (unlike rand())."""
    return F.pmod(F.xxhash64(to_col(c)), F.lit(n)).cast("int")
