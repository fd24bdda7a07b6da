from __future__ import annotations

import numpy as np
import pytest

from trackframe.llm import negatives
from trackframe.llm.negatives import Best, Cluster, _directions, _walk, hard_negatives, products

SCHEMA = "vec_id bigint, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every, k=5):
    """Plain search; rows are (id, vector, label) of usable rows."""
    v = [np.floor(256 * np.array(r[1], np.float32).astype(float)).astype(np.int64) for r in rows]
    out = []
    for a, (ident, _, label) in enumerate(rows):
        if ident % every:
            continue
        score = [int(w @ v[a]) for w in v]
        others = sorted((b for b in range(len(rows)) if b != a), key=lambda b: (-score[b], rows[b][0]))
        negative = [b for b in others if rows[b][2] != label]
        for p in [b for b in others if rows[b][2] == label][:k]:
            fits = [b for b in negative if 80 * score[p] <= 100 * score[b] <= 100 * score[p]][:k]
            out += [(ident, rows[p][0], i + 1, rows[b][0], score[p], score[b]) for i, b in enumerate(fits)]
    return sorted(out)


def made(seed, n=300, dim=5):
    rng = np.random.default_rng(seed)
    v = np.round(rng.standard_normal((n, dim)), 1)  # coarse, so many scores tie
    v[50:120] = v[50]  # a hot vector
    v[130] = 0
    return [(i, row.tolist(), int(rng.integers(0, 3))) for i, row in enumerate(v)]


@pytest.mark.parametrize("batch, cluster", [(4096, 256), (6, 3)])
def test_against_plain_search(spark, monkeypatch, batch, cluster):
    monkeypatch.setattr(negatives, "BATCH", batch)
    monkeypatch.setattr(negatives, "CLUSTER", cluster)
    rows = made(3)
    bad = [(700, None, 1), (710, [1.0] * 5, None), (720, [float("nan")] * 5, 1), (730, [None] * 5, 1), (None, [1.0] * 5, 1), (740, [], 1), (750, [1.0] * 4, 1)]
    df = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "1 AS `row`", "'b' AS id", "2 AS slot", "3 AS x").repartition(5)
    got = hard_negatives(df, anchor_every=10)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10)


def test_repeated_rows_and_nothing(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [0.9, 0.1], 2), (4, [0.9, 0.1], 2)]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), anchor_every=10)
    # Each of the two anchor rows has the other and row 3 as positives, and both rows 4 as negatives.
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10) and got.count() == 8
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    few = hard_negatives(spark.createDataFrame([(100, [1.0], 1), (200, [1.0], 2), (3, [1.0], 2)], SCHEMA))
    assert [tuple(r) for r in few.collect()] == [(200, 3, 1, 100, 65536, 65536)]  # row 100 has no positive
    assert hard_negatives(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)).count() == 0  # no anchor at all


def test_walk_ends_early_and_loses_nothing(monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rng = np.random.default_rng(2)
    heads = rng.standard_normal((8, 12))
    x = np.floor(256 * (heads[rng.integers(0, 8, 2000)] + 0.05 * rng.standard_normal((2000, 12)))).astype(np.int64)
    anchors = np.floor(256 * (heads[0] + 0.05 * rng.standard_normal((20, 12)))).astype(np.int64)
    batch = {"x": x, "unit": _directions(x.astype(float)), "size": np.linalg.norm(x.astype(float), axis=1),
             "label": np.zeros(2000, np.int64), "id": np.arange(2000), "row": np.arange(2000)}
    found = Best(20, 5)
    taken = _walk(Cluster(-1 - np.arange(20), np.zeros(20, np.int64), anchors), found, 0, batch)
    assert 0 < taken < 0.4 * 20 * 2000
    score = anchors @ x.T
    for a in range(20):
        mine = found.slot == a
        assert found.id[mine].tolist() == sorted(range(2000), key=lambda c: (-score[a, c], c))[:5]


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(5)
    for top in (100, 1 << 20, 1 << 28):
        a, b = rng.integers(-top, top, (7, 9)), rng.integers(-top, top, (5, 9))
        assert (products(a, b) == a.astype(object) @ b.astype(object).T).all()
