from __future__ import annotations

import hashlib
import random

from llm_data import SCHEMA, documents, frame, sentence
from pyspark.sql import functions as F

from trackframe.llm.catalog import op5_fingerprints
from trackframe.llm.fingerprint import edited_fingerprints, merge_sketches, with_sketch


def shingles(text):
    w = [p for p in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if p]
    return [w[i:i + 5] for i in range(max(1, len(w) - 4))] if w else []


def test_matches_brute_force(spark):
    rows = [r for r in documents() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in edited_fingerprints(docs.repartition(3)).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    texts = [r[1] or "" for r in ordered]
    edited = [t[:len(t) - len(t) // 2] + texts[(i + 1) % len(texts)][:len(t) // 2] for i, t in enumerate(texts)]
    every = sorted({tuple(s) for t in texts + edited for s in shingles(t)})
    hashed = {tuple(r["s"]): r["h"] for r in spark.createDataFrame([(list(s),) for s in every], "s array<string>")
              .select("s", F.xxhash64("s").alias("h")).collect()}
    limit = -(1 << 63) + (1 << 60)

    def sketch(t):
        h = {hashed[tuple(s)] for s in shingles(t)}
        return {min(h)} | {x for x in h if x < limit} if h else set()

    def like(a, b):
        return 1.0 if not a and not b else 0.0 if not a or not b else len(a & b) / min(len(a), len(b))
    for i, r in enumerate(ordered):
        g, mine, theirs, following = got[r[0]], sketch(texts[i]), sketch(edited[i]), sketch(texts[(i + 1) % len(texts)])
        assert g["n_chars"] == len(texts[i])
        assert g["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert g["fingerprint"] == "".join(f"{x & (1 << 64) - 1:016x}" for x in sorted(mine))
        assert g["edited_fingerprint"] == "".join(f"{x & (1 << 64) - 1:016x}" for x in sorted(theirs))
        assert abs(g["near_edited"] - like(mine, theirs)) < 1e-12 and abs(g["near_next"] - like(mine, following)) < 1e-12


def test_order_over_many_ranges(spark):
    ids = [i * i * 37 - 5000 for i in range(9000)]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r["edited_sha256"] for r in edited_fingerprints(docs).collect()}
    ids.sort(reverse=True)
    for i, k in enumerate(ids):
        t, n = f"t{k}", f"t{ids[(i + 1) % len(ids)]}"
        assert got[k] == hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest()


def test_odd_rows(spark):
    got = edited_fingerprints(frame(spark, extra=True)).collect()
    assert len(got) == len(documents()) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert edited_fingerprints(frame(spark, [])).count() == 0
    one = edited_fingerprints(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_sketches_merge(spark):
    rows = spark.createDataFrame([("one two three four five six seven " * 40,), ("alpha beta gamma delta epsilon " * 9,)], "t string")
    parts = with_sketch(rows, "t", "s", fraction=0.5).collect()
    assert all(p["s"] == sorted(set(p["s"])) and p["s"] for p in parts)


def test_likeness_is_that_of_the_returned_fingerprints(spark, tmp_path):
    """Whoever holds the strings can reckon near_* from them; short texts inside long ones come out near containment."""
    rng = random.Random(6)
    texts = []
    for n in (1, 5, 6, 9, 17, 24, 64, 130, 255) * 3:  # a short text, then a long one that holds it
        short = sentence(rng, n)
        texts += [short, sentence(rng, 700) + " " + short + " " + sentence(rng, 900)]
    texts += ["", "x " * 300, "x " * 5, sentence(rng, 400), None]
    rows = [(1000 - i, t, "en", "s", 0) for i, t in enumerate(texts)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in op5_fingerprints(spark, str(tmp_path)).collect()}

    def hashes(fingerprint):
        return {fingerprint[i:i + 16] for i in range(0, len(fingerprint), 16)}

    def like(a, b):
        a, b = hashes(a), hashes(b)
        return 1.0 if not a and not b else 0.0 if not a or not b else len(a & b) / min(len(a), len(b))
    for i in range(len(texts)):
        mine, following = got[1000 - i], got[1000 - (i + 1) % len(texts)]
        assert mine["near_edited"] == like(mine["fingerprint"], mine["edited_fingerprint"])
        assert mine["near_next"] == like(mine["fingerprint"], following["fingerprint"])
    short = [got[1000 - i]["near_next"] for i in range(0, 54, 2) if len(texts[i].split()) >= 17]
    assert min(short) == 1.0


def test_sketches_of_parts_merge(spark):
    rng = random.Random(9)
    parts = [sentence(rng, n) for n in (5, 5, 6, 7, 200, 5)]
    rows = spark.createDataFrame([(a, b) for a in parts for b in parts], "a string, b string")
    for c in "ab":
        rows = with_sketch(rows, c, f"s{c}")
    got = rows.select("*", merge_sketches("sa", "sb").alias("m")).collect()
    limit = -(1 << 63) + (1 << 60)
    for r in got:
        low = sorted({h for h in r["sa"] + r["sb"] if h < limit})
        assert r["m"] == (low or [min(r["sa"] + r["sb"])])
