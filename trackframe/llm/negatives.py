"""Hard-negative mining with candidate lists shared by clusters of anchors.

Anchors are clustered by direction. For a cluster with centre c and half-angle t,
no member's product with a candidate v can exceed ``|anchor| |v| cos(max(0, angle(c, v) - t))``.
A task sorts its candidates by that bound once per cluster; every member then walks
the shared list in blocks (one matrix product per block for all members still walking) and
stops at the first candidate whose bound is below what the member already holds: all later ones
are certified to be worse. The result is exact, whatever the clusters are like.

Anchors are the stated query set: they go through in batches of bounded size, each one
broadcast to scans of all candidates, which are never shuffled. A task hands on the best few
of each anchor, and Spark merges them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from trackframe.session import scratch_path

from .staging import stage
from .textops import map_batches
from .vectors import integer_vectors, integers, main_dimension

POSITIVES, NEGATIVES = 5, 5
# Anchors of a broadcast batch, of a cluster, and those the centres are fitted on (smallest hashes).
BATCH, CLUSTER, SAMPLE = 4096, 256, 8192
MOST_CENTRES = 512
# Candidates whose products are taken at once.
BLOCK = 2048
_EXACT = float(1 << 53)


def _directions(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def centres(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Spherical k-means centres (unit rows) of the rows of ``x``."""
    unit = _directions(x.astype(float))
    k = max(1, min(k, len(unit)))
    c = unit[np.random.default_rng(seed).choice(len(unit), k, replace=False)] if len(unit) else np.zeros((1, x.shape[1]))
    for _ in range(rounds if len(unit) else 0):
        near = np.argmax(unit @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, unit)
        c = np.where(np.linalg.norm(total, axis=1, keepdims=True) > 0, _directions(total), c)
    return c


@dataclass
class Cluster:
    """Anchors around one centre: row numbers, labels, vectors, and for the second pass ``floor <= score <= top`` per positive."""

    row: np.ndarray
    label: np.ndarray
    x: np.ndarray
    top: np.ndarray | None = None
    floor: np.ndarray | None = None

    def __post_init__(self):
        self.size = np.linalg.norm(self.x.astype(float), axis=1)
        unit = _directions(self.x.astype(float))
        self.centre = _directions(unit.sum(0, keepdims=True))[0]
        self.angle = float(np.arccos(np.clip(unit @ self.centre, -1, 1)).max(initial=0.0))

    def bounds(self, unit: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each candidate, what a member's product with it cannot exceed, per unit of the member's length."""
        apart = np.arccos(np.clip(unit @ self.centre, -1, 1))
        # The slack covers the rounding of the angles (arccos is least exact near 0 and pi).
        return size * (np.cos(np.maximum(0.0, apart - self.angle - 1e-7)) + 1e-12)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if largest < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Best:
    """The ``k`` best (highest score, then smallest id) candidates seen so far of each of ``n`` slots."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.slot = np.zeros(0, np.int64)
        self.score, self.id, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        # The score of the k-th best: what a newcomer has to reach.
        self.least = np.full(n, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        ident, row = np.concatenate([self.id, ident]), np.concatenate([self.row, row])
        order = np.lexsort((row, ident, -score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        kept = place < self.k
        order = order[kept]
        self.slot, self.score, self.id, self.row = slot[kept], score[order], ident[order], row[order]
        last = place[kept] == self.k - 1
        self.least[self.slot[last]] = self.score[last]

    def offer(self, slots: np.ndarray, scores: np.ndarray, open_: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        """Candidates by columns: ``scores`` and the mask ``open_`` have a row for each of ``slots``."""
        least = self.least[slots]
        open_ = open_ & (scores >= least[:, None])
        # Of one block no more than its k best (and their equals) can enter.
        crowded = np.flatnonzero(open_.sum(1) > 4 * self.k)
        if len(crowded):
            part = np.where(open_[crowded], scores[crowded], np.iinfo(np.int64).min)
            kth = np.partition(part, part.shape[1] - self.k, axis=1)[:, part.shape[1] - self.k]
            open_[crowded] &= scores[crowded] >= kth[:, None]
        at, column = np.nonzero(open_)
        self.add(slots[at], scores[at, column], ident[column], row[column])


def _walk(cluster: Cluster, found: Best, first: int, batch: dict) -> int:
    """Let the members walk the candidates of one batch; slots ``first`` on are theirs. Returns the products taken."""
    taken, many, per = 0, len(cluster.row), 1 if cluster.top is None else cluster.top.shape[1]
    bound = cluster.bounds(batch["unit"], batch["size"])
    order = np.argsort(-bound, kind="stable")
    for at in range(0, len(order), BLOCK):
        part = order[at:at + BLOCK]
        least = found.least[first:first + many * per].reshape(many, per)
        if cluster.floor is not None:
            least = np.maximum(least, cluster.floor)
        # All later candidates have smaller bounds: a member whose worst slot needs more is done.
        walking = np.flatnonzero(cluster.size * bound[part[0]] + 1e-6 >= least.min(1).astype(float))
        if not len(walking):
            break
        taken += len(walking) * len(part)
        scores = products(cluster.x[walking], batch["x"][part])
        same = cluster.label[walking, None] == batch["label"][None, part]
        ident, row = batch["id"][part], batch["row"][part]
        if cluster.top is None:
            found.offer(first + walking, scores, same & (cluster.row[walking, None] != row[None]), ident, row)
            continue
        for j in range(per):
            fits = ~same & (scores <= cluster.top[walking, None, j]) & (scores >= cluster.floor[walking, None, j])
            found.offer(first + walking * per + j, scores, fits, ident, row)
    return taken


def _searched(rows: DataFrame, spec: Broadcast, dim: int, per: int, k: int) -> DataFrame:
    """``(slot, score, id)``: the best ``k`` of each task for each slot (anchor, or anchor and positive)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters = spec.value
        found = Best(sum(len(c.row) for c in clusters) * per, k)
        for b in batches:
            if not b.num_rows:
                continue
            x = integers(b.column("x"), dim)
            batch = {"x": x, "unit": _directions(x.astype(float)), "size": np.linalg.norm(x.astype(float), axis=1),
                     **{c: b.column(c).to_numpy(zero_copy_only=False) for c in ("label", "id", "row")}}
            first = 0
            for cluster in clusters:
                _walk(cluster, found, first, batch)
                first += len(cluster.row) * per
        yield pa.RecordBatch.from_arrays([pa.array(found.slot), pa.array(found.score), pa.array(found.id), pa.array(found.row)],
                                         ["slot", "score", "id", "row"])
    return map_batches(rows.select("row", "id", "label", "x"), run, "slot bigint, score bigint, id bigint, row bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each slot over all tasks, with their ``rank``."""
    w = Window.partitionBy("slot").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _clustered(anchors: DataFrame, dim: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Anchors with the number of their ``cluster``, and the first and last cluster of each batch.

    A centre's anchors are dealt by row hash into clusters of about ``CLUSTER``, so a hot centre needs no
    sorting; the driver sees a number and a count a cluster.
    """
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("x").toArrow()
    c = centres(integers(sample.column("x").combine_chunks(), dim), min(MOST_CENTRES, -(-anchors.count() // CLUSTER)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = np.argmax(_directions(integers(b.column("x"), dim).astype(float)) @ c.T, axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near)], [*b.schema.names, "centre"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
    placed = stage(map_batches(anchors, nearest, schema + ", centre bigint"), "anchors")
    sizes = {r["centre"]: r["n"] for r in placed.groupBy("centre").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return placed.withColumn("cluster", F.col("centre")), []
    parts = F.create_map(*[F.lit(int(v)) for k in sorted(sizes) for v in (k, -(-sizes[k] // CLUSTER))])
    cut = placed.withColumn("cluster", F.col("centre") * F.lit(1 << 40) + F.pmod(F.xxhash64("row"), parts[F.col("centre").cast("int")]))
    batches, held = [], 0
    for cluster, n in sorted((r["cluster"], r["n"]) for r in cut.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()):
        if batches and held + n <= BATCH:
            batches[-1] = (batches[-1][0], cluster)
        else:
            batches.append((cluster, cluster))
            held = 0
        held += n
    return cut, batches


def hard_negatives(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = 100, scale: float = 256, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least_share: tuple[int, int] = (80, 100)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of floor(scale * entry), higher first, ties by smaller id. Anchors are rows
    whose id is divisible by ``anchor_every``; their positives the first other rows of their
    label; for each, the first rows of other labels whose score times the second number of ``least_share`` is
    between the positive's times the first and the second number.

    Rows with a null id or label, or a null, empty, ragged (not of the most frequent length) or not
    wholly finite vector take no part. Rows that repeat an id are rows of their own, an anchor's
    copies are its candidates, and each anchor row gives its own results. An anchor without positives, or a positive without
    negatives, gives no row; so does an empty table. Extra columns are ignored.
    """
    spark = df.sparkSession
    low, high = least_share
    chosen = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                       F.col(vector_col).alias("vector"), F.monotonically_increasing_id().alias("row")).dropna(subset=["id", "label"])
    coded = stage(integer_vectors(chosen, "vector", scale), "candidates")
    dim = main_dimension(coded)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if dim is None:
        return spark.createDataFrame([], schema)
    rows = coded.where(F.col("dim") == dim).select("row", "id", "label", "x")
    anchors, batches = _clustered(rows.where(F.col("id") % anchor_every == 0), dim)
    path = scratch_path(spark, "negatives")
    spark.createDataFrame([], schema).write.parquet(path)
    for begin, end in batches:
        batch = anchors.where(F.col("cluster").between(begin, end)).select("cluster", "row", "id", "label", "x").orderBy("cluster", "row").toArrow().combine_chunks()
        x = integers(batch.column("x").combine_chunks(), dim)
        column = {c: batch.column(c).to_numpy() for c in ("cluster", "row", "id", "label")}
        cuts = np.flatnonzero(np.r_[True, np.diff(column["cluster"]) != 0, True])
        spans = [slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        first = spark.sparkContext.broadcast([Cluster(column["row"][s], column["label"][s], x[s]) for s in spans])
        found = _top(_searched(rows, first, dim, 1, positives), positives).select("slot", "rank", "score", "id").toArrow()
        first.destroy()
        slot, place = found.column("slot").to_numpy(), found.column("rank").to_numpy() - 1
        # A slot without a positive admits nothing: its window is empty.
        top = np.zeros((len(x), positives), np.int64)
        floor, ident = np.ones_like(top), np.zeros_like(top)
        score = found.column("score").to_numpy()
        top[slot, place], ident[slot, place] = score, found.column("id").to_numpy()
        floor[slot, place] = [-(-low * v // high) for v in score.tolist()]
        second = spark.sparkContext.broadcast([Cluster(column["row"][s], column["label"][s], x[s], top[s], floor[s]) for s in spans])
        owners = spark.createDataFrame(pa.table({
            "slot": np.arange(top.size), "anchor_id": np.repeat(column["id"], positives), "positive_id": ident.ravel(), "positive_score": top.ravel()}))
        best = _top(_searched(rows, second, dim, positives, negatives), negatives)
        best.join(F.broadcast(owners), "slot").select(
            "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(path)
        second.destroy()
    return spark.read.schema(schema).parquet(path)
