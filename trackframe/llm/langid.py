"""Language identification with a string kernel.

Texts are compared by the blended-spectrum presence kernel: the number of
distinct character n-grams (n = 1..3) two texts share, normalised by the
geometric mean of their own counts. Nyström landmarks (sample texts) turn the
kernel into features, and one ridge regression per language is fitted on them.
Texts go through the folded landmark matrix in blocks: a 0/1 matrix of texts by
the n-grams that occur in the block, times those n-grams' rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .textops import U64, characters, lower_points, map_slices, utf8

UND = "und"
SPACE = 1 << 16  # hashed n-gram space
# Fixed bounds of the fit: labelled texts used per language, and landmarks over all languages (one each at least).
PER_LANGUAGE = 400
LANDMARKS = 96
# Texts and characters of a block (one text at least).
BLOCK_TEXTS = 64
BLOCK_CHARS = 1 << 18


def gram_ids(offsets: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, id)`` of every lower-cased n-gram of 1 to 3 characters, hashed; repeats included."""
    x = lower_points(points).astype(U64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = offsets[1:][text]
    at = np.arange(len(x))
    texts, ids = [], []
    gram = np.zeros(len(x), U64)
    for n in (1, 2, 3):
        gram = (gram[:len(x) - n + 1] << U64(21)) | x[n - 1:]
        inside = at[:len(gram)] + n <= end[:len(gram)]
        hashed = ((gram[inside] << U64(2) | U64(n)) * U64(0x9E3779B97F4A7C15)) >> U64(48)
        texts.append(text[:len(gram)][inside])
        ids.append(hashed.astype(np.int64))
    return np.concatenate(texts), np.concatenate(ids)


def block_product(text: np.ndarray, ids: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
    """Normalised presence vectors of ``n`` texts times ``matrix`` (n-gram space x columns)."""
    used = np.zeros(SPACE, bool)
    used[ids] = True
    column = np.cumsum(used) - 1
    block = np.zeros((n, int(column[-1]) + 1), np.float32)
    block[text, column[ids]] = 1
    return (block @ matrix[used]) / np.sqrt(np.maximum(1, block.sum(axis=1)))[:, None]


@dataclass
class LanguageModel:
    """``weights``: hashed n-gram x language matrix; ``languages``: its columns."""

    languages: list[str]
    weights: np.ndarray

    def margins(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        offsets, points = characters(offsets, data)
        out = np.zeros((len(offsets) - 1, len(self.languages)), np.float32)
        a = 0
        while a < len(out):
            fits = int(np.searchsorted(offsets, offsets[a] + BLOCK_CHARS, "right")) - 1
            b = min(len(out), a + BLOCK_TEXTS, max(a + 1, fits))
            inner = offsets[a:b + 1] - offsets[a]
            out[a:b] = block_product(*gram_ids(inner, points[offsets[a]:offsets[b]]), b - a, self.weights)
            a = b
        return out


def fit_languages(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", *, per_language: int = PER_LANGUAGE,
                  landmarks: int = LANDMARKS, ridge: float = 1e-3) -> LanguageModel:
    """Fit on at most ``per_language`` labelled texts with a letter of each language; every language is learned.

    The sample is the same for the same rows: the texts with the smallest
    hashes, each distinct text once. Without any labelled text the model has no
    languages and answers ``und``. The model takes 256 KB a language.
    """
    labelled = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where(
        "lang is not null and text rlike '\\\\p{L}'")
    keyed = labelled.select("lang", F.xxhash64("text").alias("h"), "text")
    # Thresholds from counts keep the window's input small: some 2 * per_language hashes of each language pass.
    counts = {r["lang"]: r["n"] for r in keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return LanguageModel([], np.zeros((SPACE, 0), np.float32))
    top = (1 << 63) - 1
    limits = [min(top, int(-(1 << 63) + min(1.0, 2.0 * per_language / max(1, n)) * ((1 << 64) - 1))) for n in counts.values()]
    limit = F.map_from_arrays(F.array(*map(F.lit, counts)), F.array(*(F.lit(x).cast("bigint") for x in limits)))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = (keyed.where(F.col("h") <= limit[F.col("lang")]).dropDuplicates(["lang", "h"])
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language).select("lang", "h", "text"))

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, points = characters(*utf8(batch.column("text")))
        ids = [np.unique(gram_ids(np.array([0, b - a]), points[a:b])[1]).astype(np.int32)
               for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        return pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(ids, pa.list_(pa.int32()))],
                                          ["lang", "h", "ids"])
    sample = map_slices(chosen, "text", found, "lang string, h bigint, ids array<int>").collect()
    sample.sort(key=lambda r: (r["lang"], r["h"]))
    languages = sorted({r["lang"] for r in sample})
    texts = [np.array(r["ids"], np.int64) for r in sample]
    targets = np.searchsorted(languages, [r["lang"] for r in sample])
    each = max(1, landmarks // len(languages))
    marks = np.concatenate([np.flatnonzero(targets == k)[:each] for k in range(len(languages))])
    base = np.zeros((SPACE, len(marks)), np.float32)
    for i, m in enumerate(marks):
        base[texts[m], i] = 1 / np.sqrt(len(texts[m]))
    parts = []
    for a in range(0, len(texts), BLOCK_TEXTS):
        some = texts[a:a + BLOCK_TEXTS]
        parts.append(block_product(np.repeat(np.arange(len(some)), [len(t) for t in some]), np.concatenate(some), len(some), base))
    cross = np.concatenate(parts).astype(np.float64)
    own = cross[marks]
    goal = np.where(targets[:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
    # Every language weighs the same, however many samples it has.
    weight = 1.0 / np.bincount(targets)[targets][:, None]
    left = cross.T @ (weight * cross) + ridge * own + 1e-6 * np.eye(len(marks))
    alpha = np.linalg.solve(left, cross.T @ (weight * goal))
    return LanguageModel(languages, base @ alpha.astype(np.float32))


def predict_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` appended (columns of those names are replaced).

    ``und`` with score 0 for null texts, texts without a letter, or a model
    without languages; otherwise the language of the largest margin, with the
    margins' softmax as score (six places). Ties go to the first language by name.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    docs = docs.select(*kept)
    spec = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))
    letter_col = "__letter"
    while letter_col in {c.lower() for c in kept}:
        letter_col = f"_{letter_col}"
    marked = docs.withColumn(text_col, F.col(text_col).cast("string")).select(
        "*", F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)).alias(letter_col))
    schema = marked.drop(letter_col).schema.add("lang_pred", "string").add("score", "double")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        languages, weights = spec.value
        letter = batch.column(letter_col).to_numpy(zero_copy_only=False)
        pred, score = np.full(batch.num_rows, UND, object), np.zeros(batch.num_rows)
        if languages:
            z = LanguageModel(languages, weights).margins(*utf8(batch.column(text_col)))
            e = np.exp(4.0 * (z - z.max(axis=1, keepdims=True)).astype(np.float64))
            best = z.argmax(axis=1)
            pred[letter] = np.array(languages, object)[best][letter]
            # Sums in single precision depend on the block in their last digits.
            score[letter] = (e.max(axis=1) / e.sum(axis=1)).round(6)[letter]
        cols = [batch.column(c) for c in kept]
        return pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])
    return map_slices(marked, text_col, run, schema)
