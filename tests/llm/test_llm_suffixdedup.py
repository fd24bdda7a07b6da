from __future__ import annotations

from collections import Counter

import numpy as np
from llm_data import documents, frame

from trackframe.llm import hashfilter, suffixdedup
from trackframe.llm.suffixdedup import SIZE, remove_repeated_bytes


def brute(rows):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + SIZE] for t in texts for i in range(len(t) - SIZE + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - SIZE + 1):
            if seen[t[i:i + SIZE]] > 1:
                gone[i:i + SIZE] = [True] * SIZE
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def test_matches_brute_force(spark):
    rows = documents()
    # Partners that are best in neither order: shared left with one, shared right with another, both in part with a third.
    mid = "m" * 3 + "".join(chr(97 + i % 23) for i in range(100))
    sides = ["".join(chr(65 + (i * k + k) % 26) for i in range(150)) for k in (3, 5, 7, 11)]
    a, b = sides[0], sides[1]
    rows += [(900, a + mid + b, "en", "s", 0), (901, sides[2] + a[-30:] + mid + b[:120] + sides[3], "en", "s", 0),
             (902, sides[3] + a[-75:] + mid + b[:60] + sides[2], "en", "s", 0), (903, a[-120:] + mid + b[:20] + sides[3], "en", "s", 0),
             (904, "nul" + "\0" * 260 + "end", "en", "s", 0), (905, "\0" * 230, "en", "s", 0)]
    got = remove_repeated_bytes(frame(spark, rows, extra=True)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    want = brute(rows)
    assert sorted(map(str, (tuple(r[:4]) + (bytes(r[4]),) for r in got))) == sorted(map(str, want))


def test_more_keys_than_a_filter_holds(spark, monkeypatch):
    monkeypatch.setattr(hashfilter, "MOST_BITS", 1)
    got = remove_repeated_bytes(frame(spark, extra=True)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted(map(str, (tuple(r[:4]) + (bytes(r[4]),) for r in got))) == sorted(map(str, brute(documents())))


def test_empty_table(spark):
    assert remove_repeated_bytes(frame(spark, [])).count() == 0


def test_sample_does_not_depend_on_strides(monkeypatch):
    rng = np.random.default_rng(1)
    whole = lambda data, offsets: [np.concatenate(x).tolist() for x in zip(*suffixdedup.sampled(data, offsets))]
    for sizes in ([0, 199, 200, 0, 201, 4000], [5, 3000, 0], [1000] * 6, [0]):
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = rng.integers(0, 3, offsets[-1]).astype(np.uint8)
        monkeypatch.setattr(suffixdedup, "STRIDE", 1 << 15)
        want = whole(data, offsets)
        monkeypatch.setattr(suffixdedup, "STRIDE", 300)
        assert whole(data, offsets) == want
        starts = [(t, i) for _, _, first, last, t in zip(*want) for i in range(first, last + 1)] if want else []
        assert starts == [(t, int(offsets[t]) + i) for t, n in enumerate(sizes) for i in range(n - SIZE + 1)]


def test_ranks_without_arrays(spark):
    rows = [(c, side, *w) for c, (side, w) in enumerate([("right", [5, -1, 7, 2]), ("right", [5, -1, 7, 1]), ("left", [5, -1, 7, 2]), ("left", [-9, 0, 0, 0])])]
    strings = spark.createDataFrame(rows, "c bigint, side string, w0 bigint, w1 bigint, w2 bigint, w3 bigint")
    out = suffixdedup.ranks(strings, 4, 8)
    rank = {r["c"]: r["rank"] for r in out.collect()}
    assert rank[3] < rank[1] < rank[0] == rank[2]
    assert "collect_list" not in out._jdf.queryExecution().toString()
