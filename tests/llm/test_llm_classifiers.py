from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from llm_data import documents, frame, sentence
from pyspark.sql import functions as F

from trackframe.llm import langid, toxicity
from trackframe.llm.textops import characters, utf8


def gram_sets(texts: list[str]) -> list[set]:
    text, ids = langid.gram_ids(*characters(*utf8(pa.array(texts))))
    return [set(ids[text == i].tolist()) for i in range(len(texts))]


def test_grams_are_of_characters():
    a, b, c, d, e = gram_sets(["Abab", "abab abab", "ÄЖß", "äжß", ""])
    assert len(a) == 2 + 2 + 2 and a < b
    assert len(c) == 3 + 2 + 1 and c == d and not e


def test_characters_of_any_bytes():
    offsets, points = characters(np.array([0, 2, 5, 5]), np.frombuffer(b"a\xffz\xc3\xa9", np.uint8))
    assert offsets.tolist() == [0, 2, 4, 4] and points.tolist() == [97, 0xFFFD, 122, 0xE9]


def plain_margins(sample: dict[str, list[str]], texts: list[str], landmarks: int, ridge: float = 1e-3) -> np.ndarray:
    """Kernel ridge over Nyström landmarks with sets of n-grams, no hashing and no matrices of n-grams."""
    def grams(text: str) -> set[str]:
        low = text.lower()
        return {low[i:i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)}
    kernel = lambda a, b: len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b)))
    known = [(k, grams(t)) for k, lang in enumerate(sorted(sample)) for t in sample[lang]]
    marks = [g for k in range(len(sample)) for g in [g for j, g in known if j == k][:landmarks // len(sample)]]
    cross = np.array([[kernel(g, m) for m in marks] for _, g in known])
    own = np.array([[kernel(g, m) for m in marks] for g in marks])
    share = np.array([1 / sum(j == k for j, _ in known) for k, _ in known])[:, None]
    goal = np.array([[1.0 if j == k else -1.0 for j in range(len(sample))] for k, _ in known])
    alpha = np.linalg.solve(cross.T @ (share * cross) + ridge * own + 1e-6 * np.eye(len(marks)), cross.T @ (share * goal))
    return np.array([[kernel(g, m) for m in marks] for g in map(grams, texts)]) @ alpha


def test_languages_against_plain_kernel_ridge(spark):
    rng = random.Random(8)
    alphabets = {"aa": "abcdéf ", "bb": "defghи ", "cc": "ghiйkи "}
    made = {k: list(dict.fromkeys("".join(rng.choices(a, k=rng.randint(5, 90))) for _ in range(30))) for k, a in alphabets.items()}
    rows = [(i, t, k, "s", 0) for i, (k, t) in enumerate((k, t) for k, ts in made.items() for t in ts)]
    train = frame(spark, rows)
    hashes = {r["text"]: r["h"] for r in train.select("text", F.xxhash64("text").alias("h")).collect()}
    sample = {k: sorted(ts, key=hashes.get)[:20] for k, ts in made.items()}
    model = langid.fit_languages(train, per_language=20, landmarks=12)
    texts = ["".join(rng.choices(alphabets[k], k=rng.randint(5, 90))) for k in alphabets for _ in range(60)] + ["", "x" * 300000]
    want, got = plain_margins(sample, texts, 12), model.margins(*utf8(pa.array(texts)))
    assert np.abs(want - got).max() < 0.05  # hashed n-grams may meet
    sure = np.abs(np.sort(want, axis=1)[:, -1] - np.sort(want, axis=1)[:, -2]) > 0.1
    assert sure.sum() > 100 and (want.argmax(axis=1) == got.argmax(axis=1))[sure].all()


def test_every_language_is_learned(spark):
    rows = [(i, chr(0x4E00 + i % 300) * 3, f"l{i % 300}", "s", 0) for i in range(600)]
    model = langid.fit_languages(frame(spark, rows))
    assert len(model.languages) == 300
    got = langid.predict_languages(frame(spark, rows), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95


def test_languages_held_out(spark):
    rng = random.Random(4)
    alphabets = {"aa": "abcde ", "bb": "defgh ", "cc": "ghijk "}
    rows = [(i, "".join(rng.choices(alphabets[k], k=rng.randint(20, 200))), k, "s", 0) for i in range(150) for k in alphabets]
    model = langid.fit_languages(frame(spark, rows[:300]), per_language=40, landmarks=12)
    assert model.languages == ["aa", "bb", "cc"]
    got = langid.predict_languages(frame(spark, rows[300:]), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95 and all(0 <= r["score"] <= 1 for r in got)
    odd = langid.predict_languages(frame(spark, extra=True), model).collect()
    assert len(odd) == len(documents())
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in odd)
    none = langid.fit_languages(frame(spark, [r[:2] + (None, "s", 0) for r in rows[:5]]))
    assert {r["lang_pred"] for r in langid.predict_languages(frame(spark, rows[:5]), none).collect()} == {"und"}
    assert langid.predict_languages(frame(spark, []), model).count() == 0


def test_toxicity_held_out(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = sentence(rng, 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(["rotter", "knave", "lout"])
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(bad), 0))
    kinds = "doc_id long, toxic int, quality int"
    model = toxicity.fit_toxicity(frame(spark, rows), spark.createDataFrame([*labels[:450], (None, 1, 0), (3, None, 0)], kinds))
    assert 0 < len(model) < toxicity.SPACE / 10
    got = toxicity.score_toxicity(frame(spark, rows[450:]), model).collect()
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in got]) > 0.95
    odd = toxicity.score_toxicity(frame(spark, extra=True), model).collect()
    assert len(odd) == len(documents()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in odd)
    assert toxicity.fit_toxicity(frame(spark, rows), spark.createDataFrame([], kinds)) == {}
    assert toxicity.score_toxicity(frame(spark, []), {}).count() == 0
