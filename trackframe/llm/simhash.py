"""SimHash near-duplicate groups by covering locality-sensitive hashing.

Every bit position of the fingerprint gets a non-zero vector of radius + 1
bits. For each non-zero vector v of that size, one table hashes the bits whose
vector has an odd product with v. Up to ``radius`` differing positions span
fewer than radius + 1 dimensions, so some v is orthogonal to all of them: that
table's mask holds none of the differing bits and the pair collides there.
No pair within the radius can be missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .staging import components, stage
from .textops import map_batches, map_slices

BITS = 64
SEED = 42
# Buckets up to this many distinct fingerprints are compared inside one array;
# larger ones go through bit-flip keys, whose rows grow in proportion.
BUCKET = 256


def covering_masks(radius: int) -> list[int]:
    """One 64-bit mask per table; any ``radius`` bit positions are all outside at least one of them."""
    size = (1 << (radius + 1)) - 1
    vectors = [i % size + 1 for i in range(BITS)]
    return [sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2) for v in range(1, size + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash(text: bytes, shingle: int) -> int:
    """Fingerprint of one text: bit set if set in more than half of its shingles' XXH64; 0 without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    span = min(shingle, len(parts))
    firsts, lasts = (ends - lengths)[:len(parts) - span + 1].tolist(), ends[span - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(firsts, lasts)), np.uint64, len(firsts))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 key: Column | None = None) -> DataFrame:
    """``(doc_id, fp)``: the signed 64-bit SimHash of each whole text (null text: no words, fingerprint 0).

    ``key`` takes the place of the id, under the same name.
    """
    chosen = docs.select((F.col(id_col) if key is None else key).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        fp = [signed(simhash((t or "").encode(), shingle)) for t in texts]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])
    return map_slices(chosen, "text", run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that span the groups of a bucket linked at ``radius`` bits or fewer."""
    near = np.bitwise_count(members[:, None] ^ members[None, :]) <= radius
    left, out = set(range(len(members))), []
    while left:
        todo = [left.pop()]
        while todo:
            i = todo.pop()
            for j in [j for j in np.flatnonzero(near[i]).tolist() if j in left]:
                left.discard(j)
                todo.append(j)
                out.append((i, j))
    return out


def _bucket_edges(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for row in batch.column("members"):
                members = np.array(row.as_py(), np.int64)
                for i, j in _forest(members.view(np.uint64), radius):
                    u.append(int(members[i]))
                    v.append(int(members[j]))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
    return run


def _flips(most: int) -> np.ndarray:
    return np.array([sum(1 << i for i in chosen) for k in range(most + 1) for chosen in combinations(range(BITS), k)],
                    np.uint64)


def _flipped(most: int):
    masks = _flips(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                fp = batch.column("fp").slice(at, 64).to_numpy(zero_copy_only=False)
                key = (fp.view(np.uint64)[:, None] ^ masks[None, :]).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(fp, len(masks)))], ["key", "fp"])
    return run


def links(distinct: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``(u, v)`` edges over distinct fingerprints ``fp`` with the components of "differ in <= radius bits".

    All edges returned are real links; not every link is returned, but linked
    fingerprints are always connected. ``radius`` is 1 to 7.
    """
    masks = [signed(m) for m in covering_masks(radius)]
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)
    ])).alias("k")).select("fp", "k.t", "k.key")
    full = stage(keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
                 .where("n > 1"), "buckets")
    pairs = full.where("n = 2").where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius).select("u", "v")
    members = keys.join(full.where("n > 2").select("t", "key", "n"), ["t", "key"])
    small = (members.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("members"))
             .select("members"))
    small = map_batches(small, _bucket_edges(radius), "u bigint, v bigint")
    # Larger buckets: one end flips half the radius (rounded down), the other the rest, so two
    # fingerprints share a key exactly if one of the splits of their difference fits.
    hot = stage(members.where(F.col("n") > bucket).select("fp").distinct(), "hot-fingerprints")
    near = (map_batches(hot, _flipped(radius // 2), "key bigint, fp bigint")
            .groupBy("key").agg(F.min("fp").alias("u")))
    far = map_batches(hot, _flipped(radius - radius // 2), "key bigint, fp bigint").withColumnRenamed("fp", "v")
    wide = near.join(far, "key").where("u <> v").select("u", "v")
    return pairs.union(small).union(wide)


def _rooted(rows: DataFrame, radius: int) -> DataFrame:
    """``(fp, least, root)`` of each distinct fingerprint: its least ``doc_id`` and the root of its component."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_least(docs: DataFrame, key: Column, text_col: str = "text", *, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The least ``key`` (a struct) of each group, one row per group, as columns."""
    rows = stage(fingerprints(docs, text_col=text_col, shingle=shingle, key=key), "fingerprints")
    return _rooted(rows, radius).groupBy("root").agg(F.min("least").alias("least")).select("least.*")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3,
                   radius: int = 3) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits. Null and empty texts have fingerprint zero and
    link like any other; repeated rows stay, each with its own row; a null id
    gets a row but never names a component unless all its ids are null; extra
    columns are ignored; an empty table gives no rows.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rooted = _rooted(rows, radius)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
