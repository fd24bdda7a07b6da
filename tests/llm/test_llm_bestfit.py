from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_data import documents, frame, sentence
from tokenizers import Tokenizer

from trackframe.llm import bestfit
from trackframe.llm.bestfit import WordEncoder, best_fit, pack_best_fit
from trackframe.llm.textops import utf8

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def test_word_encoder_equals_the_library(whole):
    rng = random.Random(2)
    letters = list("abST 's're'll 'm  \n\n\t\x0b.,!?0123'’éßÀ²½×_$€日本\xa0\x85 ΣςσİıA") + ["é", " ́", "<|endoftext|>", "<|start", "n't", "が", "\x1c", "'RE", "'S", "''s", "'ll2", "İ!", "É", "¾"]
    texts = [r[1] or "" for r in documents()] + ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(4000)]
    simple = [c for c in letters if all(ord(x) < 0x240 and x not in "\xa0\x85İ" for x in c) and "<|e" not in c]
    texts += ["".join(rng.choices(simple, k=rng.randint(0, 14))) for _ in range(6000)]
    encoder = WordEncoder(PATH, keep=500)
    for i in range(0, len(texts), 300):
        part = texts[i:i + 300]
        ids, bounds = encoder.encode(*utf8(pa.array(part, pa.large_string())))
        for k, t in enumerate(part):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_best_fit_against_a_plain_search():
    rng = np.random.default_rng(1)
    for capacity, n in ((10, 60), (50, 200), (7, 0)):
        sizes = rng.integers(1, capacity + 1, n)
        where, offset, fills = best_fit(sizes, capacity)
        plain: list[int] = []
        for size in sorted(sizes.tolist(), reverse=True):
            fitting = [b for b in range(len(plain)) if plain[b] + size <= capacity]
            if fitting:
                plain[max(fitting, key=lambda b: plain[b])] += size
            else:
                plain.append(size)
        assert sorted(fills.tolist()) == sorted(plain)
        for b in range(len(fills)):
            at = np.flatnonzero(where == b)
            at = at[np.argsort(offset[at])]
            assert offset[at].tolist() == [0, *np.cumsum(sizes[at])[:-1].tolist()] and sizes[at].sum() == fills[b]


def check(rows, got, whole, window):
    """Every id is in one piece, pieces are cut only where they must be, sequences are gapless."""
    ids = {}
    for r in rows:
        ids.setdefault(r[0], []).append([*whole.encode(r[1] or "", add_special_tokens=False).ids, 0])
    expected = sorted(((d is None, d or 0), p, p * window, len(x[p * window:(p + 1) * window]),
                       zlib.crc32(np.array(x[p * window:(p + 1) * window], "<u4").tobytes()))
                      for d, texts in ids.items() for x in texts for p in range(-(-len(x) // window)))
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), -(-sum(r["length"] for r in got) // window)


@pytest.mark.parametrize("group", [1 << 12, 7])
def test_packing(spark, whole, monkeypatch, group):
    monkeypatch.setattr(bestfit, "GROUP", group)
    monkeypatch.setattr(bestfit, "BLOCK", 10)
    rng = random.Random(8)
    rows = documents() + [(500 + i, sentence(rng, rng.randint(1, 60)), "en", "s", 1) for i in range(150)]
    df = frame(spark, rows, extra=True).selectExpr("*", "1 AS bin", "2 AS fill", "3 AS members").repartition(6)
    n, least = check(rows, pack_best_fit(df, PATH, window=64).collect(), whole, 64)
    assert n <= least * (1.03 if group > 7 else 1.1) + 1


def test_large_window_and_nothing(spark, whole):
    rows = documents()
    n, least = check(rows, pack_best_fit(frame(spark), PATH).collect(), whole, 2048)
    assert n == least
    assert pack_best_fit(frame(spark, []), PATH).count() == 0


def test_items_that_cannot_be_joined_end_the_rounds(spark):
    # Every piece is over half a window: no two fit together, and the rounds must stop.
    rows = [(i, "cat " * 40, None, None, None) for i in range(50)]
    assert pack_best_fit(frame(spark, rows).repartition(5), PATH, window=64).select("sequence_id").distinct().count() == 50
