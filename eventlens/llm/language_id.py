"""Language identification with a blended-spectrum string kernel.

A text's features are the sets of character n-grams (n = 1 to 4, lower case,
runs of letters with one blank between) that are present in it, each set hashed
into ``2**bits`` places. The kernel of two texts is the mean over n of the
cosine of their presence sets. A text of more than ``STRETCH`` letters and blanks is cut
into equal stretches, whose scores are averaged: sets of a bounded text do not
fill up. Landmark texts (Nystroem) map a text to the
kernels with them, whitened by the landmarks' own kernel matrix; one ridge
regression per language (one versus rest) is solved in that space. Whitening
and weights fold into one matrix, so a text is scored by two matrix products.

Fitting reads a bounded sample: about ``per_language`` distinct texts with a
letter of each learned language (all, if it has fewer), chosen by a hash of
the text, of which about ``landmarks`` in all become landmarks. Copies count
once, in the share that is taken as in the sample; a long text gives one of its
stretches, chosen by its hash. What reaches the driver are their packed presence
sets, 2 kB each, which it turns into kernels block by block. Prediction reads every whole text and nothing but the text.

Defined results: null text, or one without any letter, is ``und`` with score 0;
rows of null language are not learned from; with no training rows at all every
text is ``und``; repeated rows are predicted alike; of languages with equal scores
the first by name is taken; very long texts are read whole, stretch by stretch; other
columns pass through (``lang_pred`` and ``score`` are replaced); an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import mix, per_task, release, small_batches, table

UNDETERMINED = "und"
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
ORDERS = (1, 2, 3, 4)


#: Most code points of a stretch.
STRETCH = 1 << 16
#: Texts whose kernels are taken at a time.
ROWS = 128


def stretches(text: str) -> list[str]:
    """The text's runs of letters with one blank between, lower case, in equal parts; none if it has no letter."""
    if not text or not _LETTER.search(text):
        return []
    runs = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    parts = -(-len(runs) // STRETCH)
    return [runs[len(runs) * i // parts:len(runs) * (i + 1) // parts] for i in range(parts)]


def presence(stretch: str, bits: int) -> np.ndarray:
    """Presence sets (orders x places) of a stretch."""
    codes = np.frombuffer(stretch.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    out = np.zeros((len(ORDERS), 1 << bits), dtype=bool)
    grams = np.zeros(codes.size, dtype=np.uint64)
    for k, n in enumerate(ORDERS):
        if codes.size < n:
            break
        grams = grams[:codes.size - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        out[k, mix(grams) >> np.uint64(64 - bits)] = True
    return out


def unit(sets: np.ndarray) -> np.ndarray:
    """Each order's set at unit length, so that a dot product of all is the blended kernel."""
    norm = np.sqrt(np.maximum(sets.sum(axis=-1, keepdims=True), 1) * len(ORDERS)).astype(np.float32)
    return (sets / norm).reshape(*sets.shape[:-2], -1)


@dataclass(frozen=True)
class Model:
    """Languages, landmark features and the folded weights (landmarks x languages)."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray
    bits: int


def train(rows: list[tuple[str, bytes]], landmarks: int, ridge: float, bits: int) -> Model:
    """Kernel ridge on Nystroem features of (language, packed presence sets) rows."""
    names = tuple(sorted({lang for lang, _ in rows}))
    if not rows:
        return Model((), np.empty((0, 0), np.float32), np.empty((0, 0), np.float32), bits)

    def features(part) -> np.ndarray:
        packed = np.frombuffer(b"".join(sets for _, sets in part), np.uint8).reshape(len(part), -1)
        return unit(np.unpackbits(packed, axis=1).reshape(len(part), len(ORDERS), 1 << bits))

    y = np.array([[lang == n for n in names] for lang, _ in rows], dtype=np.float64)
    # Landmarks in turn from every language; rows come in a fixed order.
    turn: dict[str, int] = {}
    order = sorted(range(len(rows)), key=lambda i: (turn.__setitem__(rows[i][0], turn.get(rows[i][0], 0) + 1), turn[rows[i][0]], i)[1:])
    marks = features([rows[i] for i in order[:landmarks]])
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6 * value.max()
    white = vector[:, keep] / np.sqrt(value[keep])
    phi = np.concatenate([(features(rows[at:at + ROWS]) @ marks.T).astype(np.float64) @ white for at in range(0, len(rows), ROWS)])
    # Every language weighs the same, however many rows it has.
    w = (1 / y.sum(axis=0))[y.argmax(axis=1)][:, None]
    gram = phi.T @ (w * phi) + ridge * np.eye(phi.shape[1])
    return Model(names, marks, (white @ np.linalg.solve(gram, phi.T @ (w * y))).astype(np.float32), bits)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 300, landmarks: int = 256,
        ridge: float = 1e-3, bits: int = 12) -> Model:
    """Fits on about ``per_language`` distinct texts of every language of ``labelled``."""
    small_batches(labelled.sparkSession)
    rows = (labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
            .select(F.col(text).alias("text"), F.col(lang).alias("lang")))
    # Copies of one text have one hash: they count once, here and in the sample.
    own = F.xxhash64("text", "lang")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count_distinct(own).alias("n")).collect()}
    if not sizes:
        return train([], landmarks, ridge, bits)
    # The hash as a number in [0, 1) against the share of its language.
    share = F.element_at(F.create_map(*(F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, per_language / n)))), F.col("lang"))
    place = F.pmod(own, F.lit(1 << 52)) / float(1 << 52)

    def packed(batches):
        for batch in batches:
            got = []
            for t, lg in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = stretches(t)
                if parts:
                    got.append((lg, np.packbits(presence(parts[zlib.crc32(t.encode()) % len(parts)], bits)).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.binary())], names=["lang", "sets"])

    sample = rows.where(place < share).distinct().mapInArrow(per_task(packed), "lang string, sets binary").collect()
    model = train(sorted((r.lang, bytes(r.sets)) for r in sample), landmarks, ridge, bits)
    release()
    return model


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def predict(batches):
        m = shared.value
        for batch in batches:
            total = np.zeros((batch.num_rows, max(1, len(m.languages))), np.float64)
            parts = np.zeros(batch.num_rows, np.int64)
            at, sets = [], []

            def score():
                np.add.at(total, at, (unit(np.stack(sets)) @ m.landmarks.T) @ m.weights)
                at.clear()
                sets.clear()

            for i, t in enumerate(batch.column(text) if m.languages else ()):
                for stretch in stretches(t.as_py()):
                    parts[i] += 1
                    at.append(i)
                    sets.append(presence(stretch, m.bits))
                    if len(sets) == ROWS:
                        score()
            if sets:
                score()
            mean = np.clip(total / np.maximum(parts, 1)[:, None], 0.0, 1.0)
            best = mean.argmax(axis=1)
            langs = [m.languages[b] if n else UNDETERMINED for b, n in zip(best.tolist(), parts.tolist(), strict=True)]
            scores = np.where(parts > 0, mean.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(per_task(predict), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Every third document by checksum: never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op8_language_id(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = fit(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "held_out", "text"), model).drop("text")
