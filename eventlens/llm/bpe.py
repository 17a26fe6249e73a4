"""Byte-level BPE by chunks: cached, with the ids of the ``tokenizers`` library.

A pre-token never goes on across the border between a visible character and a
space, and nothing before the border matters after it. So a text cut at such
borders gives the ids of its chunks one after the other, and chunks repeat
often enough to be looked up. ``tiktoken`` has the same merges and encodes the
chunks that are made of characters below U+0250; any other chunk goes to
``tokenizers``, whose character classes may differ from those of other
libraries outside that range.
"""

from __future__ import annotations

import base64
import functools
import json
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: A character that is no space in any Unicode version; a chunk may end after it.
_VISIBLE = "!-~¡-ɏ"
_UNSAFE = re.compile(f"[^{_VISIBLE}] ")
_BORDER = re.compile(f"(?<=[{_VISIBLE}])(?= )")
_OTHER = re.compile("[^\x00-ɏ]")


class Encoder:
    """Ids of texts, chunk by chunk; ``special`` strings inside texts become their id."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        with open(re.sub(r"\.json$", ".tiktoken", path), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def chunk(self, chunk: str) -> list[int]:
        if _OTHER.search(chunk):
            return self.library.encode(chunk, add_special_tokens=False).ids
        return self.plain.encode_ordinary(chunk)

    def parts(self, text: str) -> list[str]:
        """Text and special strings in turn: odd places are special."""
        return self.splitter.split(text) if self.special else [text]


@functools.cache
def encoder(name: str) -> Encoder:
    return Encoder(public_tokenizers.path(name))


class ChunkCache(dict):
    """Chunk without its leading space -> value of the chunk with it; at most ``limit`` entries."""

    def __init__(self, value, known: dict | None = None, limit: int = 150_000):
        super().__init__(known or {})
        self.value, self.known, self.limit = value, known or {}, limit

    def __missing__(self, key: str):
        out = self.value(" " + key)
        if len(key) <= 64:  # longer chunks hardly come again
            if len(self) >= self.limit:
                self.clear()
                self.update(self.known)
            self[key] = out
        return out


def chunks(text: str) -> tuple[str, list[str]]:
    """The text up to its first border, and the chunks after, each without its leading space."""
    if _UNSAFE.search(text):
        first, *rest = _BORDER.split(text)
        return first, [c[1:] for c in rest]
    first, *rest = text.split(" ")
    return first, rest


def ids_bytes(enc: Encoder, cache: ChunkCache, text: str) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit numbers."""
    out = []
    for i, part in enumerate(enc.parts(text)):
        if i % 2:
            out.append(packed([enc.special[part]]))
        elif part:
            first, rest = chunks(part)
            if first:
                out.append(packed(enc.chunk(first)))
            out.extend(map(cache.__getitem__, rest))
    return b"".join(out)


def count(enc: Encoder, cache: ChunkCache, text: str) -> int:
    """Number of ids of a whole text."""
    n = 0
    for i, part in enumerate(enc.parts(text)):
        if i % 2:
            n += 1
        elif part:
            first, rest = chunks(part)
            n += (len(enc.chunk(first)) if first else 0) + sum(map(cache.__getitem__, rest))
    return n


def packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()
