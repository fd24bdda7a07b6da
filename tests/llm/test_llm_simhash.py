from __future__ import annotations

from itertools import combinations

import xxhash
from llm_data import documents, frame

from trackframe.llm.simhash import covering_masks, links, signed, simhash_groups
from trackframe.llm.staging import components


def fingerprint(text):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i:i + 3]) for i in range(max(1, len(parts) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def groups(fps):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            parent[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_groups_match_brute_force(spark):
    rows = documents()
    fps = [fingerprint(r[1]) for r in rows]
    root = groups(set(fps))
    least = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    want = sorted(((r[0], f"{f:016x}", least.get(root[f])) for r, f in zip(rows, fps)), key=str)
    got = sorted((tuple(r) for r in simhash_groups(frame(spark, extra=True)).collect()), key=str)
    assert got == want


def test_no_three_bits_hit_every_mask():
    masks = covering_masks(3)
    assert len(masks) == 15
    for bits in combinations(range(64), 3):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_crowded_buckets_link_like_small_ones(spark):
    base = 0x0123456789ABCDEF
    fps = {base ^ (1 << a) ^ (1 << b) for a in range(0, 40, 3) for b in range(1, 40, 4)} | {base ^ 0xFFFF << 40, (base ^ 0xFFFF << 40) ^ 7}
    frame_ = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    want = groups(fps)
    for bucket in (2, 256):
        edges = links(frame_, 3, bucket)
        assert edges.where("bit_count(u ^ v) > 3").count() == 0
        root = {r["node"]: r["root"] for r in components(edges).collect()}
        got = {f: root.get(signed(f), signed(f)) for f in fps}
        assert len(set(got.values())) == len(set(want.values()))
        assert all((got[a] == got[b]) == (want[a] == want[b]) for a, b in combinations(sorted(fps)[:60], 2))


def test_empty_table(spark):
    assert simhash_groups(frame(spark, [])).count() == 0
