from __future__ import annotations

import numpy as np
import pyarrow as pa
from llm_data import documents, frame

from trackframe.llm import hashfilter
from trackframe.llm.recompress import anchors, remove_repeats, window_starts
from trackframe.llm.textops import byte_prefix, span_hash, utf8, words


def brute(rows, size=13):
    least = {}
    cut = [(r[0] if r[0] is not None else 1 << 63, (r[1] or "").encode().split()) for r in rows]
    for k, w in cut:
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            least[g] = min(least.get(g, k), k)
    out = []
    for (k, w), r in zip(cut, rows):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i:i + size])] < k:
                gone[i:i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((r[0], r[1], kept, len(w), sum(gone)))
    return out


def test_matches_brute_force(spark):
    got = remove_repeats(frame(spark, extra=True)).select("doc_id", "text", "kept", "n_words", "n_removed").collect()
    want = brute(documents())
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(w[-1] for w in want) > 300


def test_more_keys_than_a_filter_holds(spark, monkeypatch):
    monkeypatch.setattr(hashfilter, "MOST_BITS", 1)
    got = remove_repeats(frame(spark, extra=True)).select("doc_id", "text", "kept", "n_words", "n_removed").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(documents())))


def test_filters_grow_with_their_hashes():
    sizes = [hashfilter.filter_bits(n) for n in (0, 10_000, 1_000_000, 20_000_000)]
    assert sizes == [16, 18, 24, 28]
    assert hashfilter.filter_bits(1 << 25) == 28 and hashfilter.filter_bits((1 << 25) + 1) is None


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    np.seterr(over="ignore")
    core = [f"w{i}" for i in rng.integers(0, 4, 40)]  # few words: many runs and equal pairs
    texts = [" ".join([f"x{i}"] * i + core[i:] + core[:i]) for i in range(12)] + [" ".join(core * 3), "a " * 50]
    offsets, data = utf8(pa.array(texts))
    starts, ends, bounds = words(offsets, data)
    names = span_hash(byte_prefix(data), starts, ends)
    key, at = anchors(names, bounds), window_starts(bounds)
    seen = {}
    for k, i in zip(key.tolist(), at.tolist()):
        assert seen.setdefault(tuple(names[i:i + 13].tolist()), k) == k


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
