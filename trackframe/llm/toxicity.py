"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its lower-cased words, their stems
(first five bytes), adjacent word pairs and pairs with one word between. FTRL-proximal keeps a learning rate
per coordinate and an L1 threshold, so most of the 2**18 weights are exactly
zero and the model is a short list of (feature, weight) pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textops import U64, byte_codes, map_batches, map_slices, mix, prefix_hash, runs, span_hash, utf8

SPACE = 1 << 18
STEM = 5
# Fixed bound of the fit: at most this many labelled rows, those with the smallest id hashes.
TRAIN_ROWS = 16384
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 6.0, 0.0

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = byte_codes(8)[_LOWER]


def features(offsets: np.ndarray, data: np.ndarray) -> Iterator[np.ndarray]:
    """For each text its distinct feature ids (coordinate 0 is the bias and always present)."""
    starts, ends = runs(_WORD[data], offsets)
    prefix = prefix_hash(_CODES[data])
    one = span_hash(prefix, starts, ends)
    stem = mix(span_hash(prefix, starts, np.minimum(ends, starts + STEM)) + U64(7))
    two = mix(one[:-1] * U64(3) + one[1:]) if len(one) > 1 else one[:0]
    skip = mix(one[:-2] * U64(5) + one[2:]) if len(one) > 2 else one[:0]
    bounds = np.searchsorted(starts, offsets).tolist()
    ids = [(x >> U64(46)).astype(np.int32) for x in (one, two, skip, stem)]
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield np.unique(np.concatenate([[0], ids[0][a:b], ids[1][a:max(a, b - 1)], ids[2][a:max(a, b - 2)], ids[3][a:b]]).astype(np.int32))


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over ``(feature ids, label)`` rows."""
    z, n = np.zeros(SPACE), np.zeros(SPACE)
    for _ in range(epochs):
        for ids, label in rows:
            zi, ni = z[ids], n[ids]
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[ids] = zi + g - sigma * w
            n[ids] = ni + g * g
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> dict[int, float]:
    """Non-zero weights by feature id, fitted on at most ``max_rows`` labelled ids.

    An id labelled more than once counts as 1 if any of its labels is 1; null
    ids and labels are left out; without labelled rows the model is empty.
    """
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
             .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The limit above bounds the broadcast: an id, a label and a hash for each of max_rows rows.
    joined = texts.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).select("h", "y", "text")

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = list(features(*utf8(batch.column("text"))))
        return pa.RecordBatch.from_arrays([batch.column("h"), batch.column("y"), pa.array(ids, pa.list_(pa.int32()))],
                                          ["h", "y", "ids"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(ids.values.to_numpy(), int(y)) for b in batches for ids, y in zip(b.column("ids"), b.column("y").to_pylist())]
        w = ftrl(rows, epochs)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], ["id", "w"])
    sample = map_slices(joined, "text", hashed, "h bigint, y int, ids array<int>")
    one = sample.repartition(1).sortWithinPartitions("h")
    return {r["id"]: r["w"] for r in map_batches(one, train, "id int, w double").collect()}


def score_toxicity(docs: DataFrame, model: dict[int, float], text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5) appended; existing such columns are replaced.

    Null and empty texts get the bias alone; an empty model scores 0.5.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    docs = docs.select(*kept)
    ids = np.fromiter(model.keys(), np.int64, len(model))
    spec = docs.sparkSession.sparkContext.broadcast((ids, np.fromiter(model.values(), float, len(model))))
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = docs.select("*").schema.add("score", "double").add("predicted", "integer")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = np.zeros(SPACE)
        w[spec.value[0]] = spec.value[1]
        raw = np.array([w[x].sum() for x in features(*utf8(batch.column(text_col)))])
        score = 1 / (1 + np.exp(-np.clip(raw, -35, 35)))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                          [*kept, "score", "predicted"])
    return map_slices(docs, text_col, run, schema)
