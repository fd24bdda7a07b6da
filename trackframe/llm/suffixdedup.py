"""Removal of long byte strings that occur more than once, by a sampled suffix order.

The algorithm follows the difference-cover scheme: sort a sample of suffixes,
place the others by their distance to the next sampled one, compare neighbours.

1. Sample. The positions kept are the minima of gram hashes over sliding windows.
   Like a difference cover, they hold for any two equal strings of ``SIZE`` bytes a
   common offset at which both are sampled. Sampled grams that occur once are dropped.
2. Names. Around a sampled position lie the bytes that its strings can reach,
   to the right and (reversed) to the left. They are cut into words; distinct triples
   of words are sorted and named by rank, triples of names again, until one
   name is left for each side: its rank.
3. Neighbours. In the order by right rank the longest common prefixes of a suffix
   are with its neighbours, in the order by left rank the longest common left parts.
4. Every other suffix is a sampled one with o bytes before it: its string is
   repeated if some partner shares o bytes to the left and SIZE - o to the right.
   The neighbours decide that for nearly all; what they leave open (a partner
   that is best in neither order) is counted exactly by string.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .hashfilter import has_key, hash_filter, maybe_in, release, stand_ins, with_keys
from .staging import stage, unstage
from .textops import U64, byte_prefix, map_batches, map_slices, mix, powers, runs, sliding, span_hash, utf8

SIZE = 200
GRAM = 64
SIDE = SIZE - GRAM  # bytes that matter on each side of a sampled gram
WORDS = -(-SIDE // 8)
BLOCK = 1 << 21
STRIDE = 1 << 15  # grams hashed at once: their arrays stay in a core's cache
# Text handled at once: several arrays of eight bytes a byte are alive at a time.
SLICE = 1 << 20
ROWS = 40_000  # contexts per ordered partition


def sampled(data: np.ndarray, offsets: np.ndarray):
    """Yield ``(key, at, first, last)`` arrays: sampled positions, their gram's hash, and the string starts they stand for."""
    width = SIZE - GRAM + 1
    mask = U64((1 << 24) - 1)
    for begin in range(0, max(1, len(data)), BLOCK):
        part = data[begin:begin + BLOCK + SIZE - 1]
        n = len(part) - SIZE + 1
        if n < 1:
            return
        grams, at = np.empty(len(part) - GRAM + 1, U64), np.empty(n, np.int64)
        for a in range(0, n, STRIDE):
            prefix = byte_prefix(part[a:a + STRIDE + SIZE - 1])
            own = mix((prefix[GRAM:] - prefix[:-GRAM]) * powers(len(prefix))[1][:len(prefix) - GRAM])
            grams[a:a + len(own)] = own
            least = sliding((own & ~mask) | np.arange(len(own), dtype=U64), width, np.minimum)
            at[a:a + len(least)] = (least & mask).astype(np.int64) + a
        # Starts low[i] to high[i] - 1 are the strings of text i that begin in the block.
        low, high = (np.clip(x, begin, begin + n) - begin for x in (offsets[:-1], offsets[1:] - SIZE + 1))
        new = np.zeros(n, bool)
        new[1:] = at[1:] != at[:-1]
        new[low[low < high]] = True
        heads = np.flatnonzero(new)
        text = np.searchsorted(offsets, begin + heads, "right") - 1
        inside = heads < high[text]
        heads, text = heads[inside], text[inside]
        if not len(heads):
            continue
        tails = np.minimum(np.append(heads[1:], n), high[text]) - 1
        yield grams[at[heads]], at[heads] + begin, heads + begin, tails + begin, text


def number(df: DataFrame, cols: list[str], rows: int, label: str) -> DataFrame:
    """``df`` with ``rank``: its place in the order by ``cols`` (0-based, distinct), computed by ranges."""
    parts = max(1, -(-rows // (8 * ROWS)))
    ranged = df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            i = pa.array(np.arange(at, at + b.num_rows))
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), i], [*b.schema.names, "part", "i"])
    from pyspark.sql.types import IntegerType, LongType, StructType
    schema = StructType(list(df.schema.fields)).add("part", IntegerType()).add("i", LongType())
    placed = stage(map_batches(ranged, count, schema), label)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return placed.join(F.broadcast(before), "part").select(*df.columns, (F.col("before") + F.col("i")).alias("rank"))


def ranks(strings: DataFrame, words: int, rows: int) -> DataFrame:
    """``(c, side, rank)`` of strings given as ``c, side`` and their ``words`` order-keeping longs, ``w0``, ``w1`` ...

    Equal strings share a rank. Each round sorts and names the distinct triples.
    """
    width = words
    while width > 1:
        triples = -(-width // 3)
        at = lambda i: f"w{i}" if i < width else f"{-(1 << 63)}L"
        rowed = stage(strings.selectExpr("c", "side", f"stack({triples}, " + ", ".join(
            f"{j}, {at(3 * j)}, {at(3 * j + 1)}, {at(3 * j + 2)}" for j in range(triples)) + ") as (j, x, y, z)"), "triples")
        named = number(rowed.select("x", "y", "z").distinct(), ["x", "y", "z"], rows * triples, "names")
        strings = rowed.join(named, ["x", "y", "z"]).groupBy("c", "side").agg(
            *(F.max(F.when(F.col("j") == j, F.col("rank"))).alias(f"w{j}") for j in range(triples)))
        width = triples
    return strings.select("c", "side", F.col("w0").alias("rank"))


def _pad(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Binary column as rows of SIDE bytes (zeros behind) and the true lengths."""
    offsets, data = utf8(column)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), SIDE), np.uint8)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(data)) - np.repeat(offsets[:-1], lengths)] = data
    return out, lengths


def _common(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), SIDE), np.minimum(la, lb))


def neighbours(contexts: DataFrame, order: list[str], rows: int, label: str) -> DataFrame:
    """``(c, lcp, lcs)``: common right and left bytes of each context with its neighbours in the order, both directions."""
    parts = max(1, -(-rows // ROWS))
    ranged = contexts.select("c", "key", *order, "right", "left").repartitionByRange(parts, "key", *order).sortWithinPartitions("key", *order)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = list(batches)  # about ROWS contexts: the order's keys are all distinct
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        c, key = (t.column(k).to_numpy(zero_copy_only=False) for k in ("c", "key"))
        right, rl = _pad(t.column("right"))
        left, ll = _pad(t.column("left"))
        same = key[1:] == key[:-1]
        lcp = _common(right[1:], right[:-1], rl[1:], rl[:-1])[same]
        lcs = _common(left[1:], left[:-1], ll[1:], ll[:-1])[same]
        who = np.concatenate([c[1:][same], c[:-1][same]])
        none = pa.nulls(len(who), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(np.tile(lcp, 2).astype(np.int32)), pa.array(np.tile(lcs, 2).astype(np.int32)),
                                          pa.nulls(len(who), pa.int32()), pa.nulls(len(who), pa.int64()), none, none],
                                         ["c", "lcp", "lcs", "part", "key", "right", "left"])
        ends = [0, len(c) - 1]
        yield pa.RecordBatch.from_arrays([pa.array(c[ends]), pa.array([0, 1], pa.int32()), pa.array([0, 0], pa.int32()),
                                          pa.array([part] * 2, pa.int32()), pa.array(key[ends]),
                                          *(t.column(k).take(pa.array(ends)) for k in ("right", "left"))],
                                         ["c", "lcp", "lcs", "part", "key", "right", "left"])
    found = stage(map_batches(ranged, beside, "c bigint, lcp int, lcs int, part int, key bigint, right binary, left binary"), label)
    # Where two partitions meet: two rows a partition come to the driver.
    ends = sorted(((r["part"], r["lcp"], r) for r in found.where("part is not null").collect()), key=lambda e: e[:2])
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    extra = []
    for (p, end, a), (q, _, b) in zip(ends, ends[1:]):
        if p != q and a["key"] == b["key"]:
            pair = (common(a["right"], b["right"]), common(a["left"], b["left"]))
            extra += [(a["c"], *pair), (b["c"], *pair)]
    inside = found.where("part is null").select("c", "lcp", "lcs")
    return inside.union(inside.sparkSession.createDataFrame(extra, inside.schema)) if extra else inside


def _spans(df: DataFrame) -> DataFrame:
    """Proven and open distance ranges of contexts that occur once, from their neighbours: ``c, low, high, open``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, lo, hi, nul = (b.column(k).to_numpy(zero_copy_only=False) for k in ("c", "omin", "omax", "nul"))
            met = b.column("near").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            whose, pairs = np.repeat(np.arange(len(c)), met), b.column("near").flatten()
            first, last = (pairs.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("lcp", "lcs"))
            first = SIDE - first
            least, most = np.full(len(c), SIZE), np.full(len(c), -1)
            np.minimum.at(least, whose, first)
            np.maximum.at(most, whose, last)
            # Padding and zero bytes sort alike: texts with these are left to the count.
            low, high = np.where(nul, lo, np.maximum(lo, least)), np.where(nul, hi, np.minimum(hi, most))
            size = np.maximum(0, high - low + 1)
            bounds = np.concatenate([[0], np.cumsum(size)])
            begin, end = (np.clip(x - low[whose], 0, size[whose]) for x in (first, last + 1))
            use = (begin < end) & ~nul[whose]
            covers = np.zeros(bounds[-1] + 1, np.int64)
            np.add.at(covers, (bounds[whose] + begin)[use], 1)
            np.add.at(covers, (bounds[whose] + end)[use], -1)
            proven = np.cumsum(covers[:-1]) > 0
            for mark, is_open in ((proven, False), (~proven, True)):
                starts, ends = runs(mark, bounds)
                row = np.searchsorted(bounds, starts, "right") - 1
                shift = low[row] - bounds[row]
                yield pa.RecordBatch.from_arrays([pa.array(c[row]), pa.array((starts + shift).astype(np.int32)), pa.array((ends - 1 + shift).astype(np.int32)),
                                                  pa.array(np.full(len(row), is_open))], ["c", "low", "high", "open"])
    return map_batches(df, run, "c bigint, low int, high int, open boolean")


def _strings(contexts: DataFrame) -> DataFrame:
    """Every string of the contexts: ``c, o, h1, h2, n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                for r in b.to_pylist():
                    data = np.frombuffer(r["left"][::-1] + r["gram"] + r["right"], np.uint8)
                    o = np.arange(r["omin"], r["omax"] + 1)
                    at = len(r["left"]) - o
                    h1, h2 = (span_hash(byte_prefix(data, s), at, at + SIZE).view(np.int64) for s in (1, 2))
                    fill = lambda v, t: pa.array(np.full(len(o), v), t)
                    yield pa.RecordBatch.from_arrays([fill(r["c"], pa.int64()), pa.array(o.astype(np.int32)), pa.array(h1), pa.array(h2), fill(r["n"], pa.int64())],
                                                     ["c", "o", "h1", "h2", "n"])
    return map_batches(contexts, run, "c bigint, o int, h1 bigint, h2 bigint, n bigint")


def repeated_spans(docs: DataFrame, done: ExitStack) -> DataFrame:
    """``(doc, tag, whole, starts, ends)``: bytes to remove of texts given as ``doc`` (id key), ``tag`` (hash), ``text``.

    ``done`` gets what to clear when the result is written.
    """
    copies = stage(docs.groupBy("tag", F.md5(F.col("text").cast("binary")).alias("sum"))
                   .agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")), "texts")
    # One document stands for all copies of a text. A copy that passes this filter is only judged twice.
    stands = hash_filter(copies.select(F.xxhash64("tag", "least").alias("h")), "h")
    known = docs.select("doc", "tag", "text", F.xxhash64("tag", "doc").alias("h"))
    column = lambda b, k: b.column(k).to_numpy(zero_copy_only=False)
    done.callback(unstage, copies)
    if stands is None:
        known = stage(stand_ins(known, copies), "stand-ins")
        done.callback(unstage, known)

    def grams(batch: pa.RecordBatch, owners: bool = False) -> pa.RecordBatch | None:
        batch = batch.filter(pa.array(maybe_in(stands, column(batch, "h").view(U64))))
        offsets, data = utf8(batch.column("text"))
        parts = [(part[0], part[4]) for part in sampled(data, offsets)]
        if not parts:
            return None
        key, text = (np.concatenate(x) for x in zip(*parts))
        found = [pa.array(key.view(np.int64))]
        return pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(text)) for k in ("doc", "tag")] + found, ["doc", "tag", "key"]) \
            if owners else pa.RecordBatch.from_arrays(found, ["key"])
    often = stage(map_slices(known, "text", grams, "key bigint", SLICE).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "often")
    common = hash_filter(often, "key")
    if common is None:
        owned = map_slices(known, "text", lambda b: grams(b, owners=True), "doc bigint, tag bigint, key bigint", SLICE)
        known = with_keys(known, owned, often)

    def occurrences(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        batch = batch.filter(pa.array(maybe_in(stands, column(batch, "h").view(U64))))
        offsets, data = utf8(batch.column("text"))
        found = [[x[has_key(common, batch, part[0])] for x in part] for part in sampled(data, offsets)]
        if not found:
            return None
        key, at, first, last, text = (np.concatenate(x) for x in zip(*found))
        if not len(key):
            return None
        raw = data.tobytes()
        left = [raw[a:b][::-1] for a, b in zip(first.tolist(), at.tolist())]
        right = [raw[a + GRAM:b + SIZE] for a, b in zip(at.tolist(), last.tolist())]
        one, two = (byte_prefix(data, s) for s in (1, 2))
        h1, h2 = (mix(span_hash(p, first, last + SIZE) + U64(1315423911) * (at - first).astype(U64)).view(np.int64) for p in (one, two))
        return pa.RecordBatch.from_arrays(
            [pa.array(column(batch, "doc")[text]), pa.array(column(batch, "tag")[text]), pa.array(at - offsets[text]), pa.array(key.view(np.int64)),
             pa.array(h1), pa.array(h2), pa.array((at - last).astype(np.int32)), pa.array((at - first).astype(np.int32)),
             pa.array(left, pa.binary()), pa.array([raw[a:a + GRAM] for a in at.tolist()], pa.binary()), pa.array(right, pa.binary())],
            ["doc", "tag", "at", "key", "h1", "h2", "omin", "omax", "left", "gram", "right"])
    seen = stage(map_slices(known, "text", occurrences, "doc bigint, tag bigint, at bigint, key bigint, h1 bigint, h2 bigint, omin int, omax int, "
                            "left binary, gram binary, right binary", SLICE), "sampled")
    unstage(often)
    release(common)
    release(stands)
    done.callback(unstage, seen)
    # Equal surroundings become one context, counted.
    grouped = seen.groupBy("key", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), *(F.first(k).alias(k) for k in ("omin", "omax", "left", "gram", "right")))
    contexts = stage(grouped.withColumn("c", F.monotonically_increasing_id()), "contexts")
    done.callback(unstage, contexts)
    # Contexts that occur more than once are settled. Only those of grams with another context are ordered: what
    # a filter let through by chance has none, and costs nothing from here on.
    single = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("fewest")).where("contexts > 1 and fewest = 1").select("key")
    compared = stage(contexts.join(single, "key", "left_semi"), "compared")
    rows = compared.count()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for side in ("right", "left"):
                bytes_, _ = _pad(b.column(side))
                full = np.zeros((len(bytes_), WORDS * 8), np.uint8)
                full[:, :SIDE] = bytes_
                w = (full.view(">u8").astype(U64) ^ U64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("c"), pa.array([side] * b.num_rows), *(pa.array(w[:, i].copy()) for i in range(WORDS))],
                                                 ["c", "side", *(f"w{i}" for i in range(WORDS))])
    strings = map_batches(compared.select("c", "right", "left"), words, "c bigint, side string, " + ", ".join(f"w{i} bigint" for i in range(WORDS)))
    ranked = ranks(strings, WORDS, 2 * rows).groupBy("c").agg(
        F.max(F.when(F.col("side") == "right", F.col("rank"))).alias("r"), F.max(F.when(F.col("side") == "left", F.col("rank"))).alias("l"))
    ordered = stage(compared.select("c", "key", "right", "left").join(ranked, "c"), "ranked")
    for used in (compared, ordered):
        done.callback(unstage, used)
    near = neighbours(ordered, ["r", "l"], rows, "by-right").union(neighbours(ordered, ["l", "r"], rows, "by-left"))
    near = near.groupBy("c").agg(F.collect_list(F.struct("lcp", "lcs")).alias("near"))  # at most eight
    nul = (F.instr(F.hex("right"), "00") > 0) | (F.instr(F.hex("left"), "00") > 0)
    settled = contexts.where("n > 1").select("c", F.col("omin").alias("low"), F.col("omax").alias("high"), F.lit(False).alias("open"))
    judged = stage(_spans(compared.where("n = 1").select("c", "omin", "omax", nul.alias("nul")).join(near, "c", "left")).union(settled), "spans")
    done.callback(unstage, judged)
    # What neighbours leave open: count the strings of all contexts with those grams.
    unsure = judged.where("open")
    keys = compared.join(unsure.select("c").distinct(), "c", "left_semi").select("key").distinct()
    strings_ = stage(_strings(compared.join(keys, "key", "left_semi").select("c", "omin", "omax", "n", "left", "gram", "right")), "open-strings")
    done.callback(unstage, strings_)
    twice = strings_.groupBy("o", "h1", "h2").agg(F.sum("n").alias("m")).where("m > 1").select("o", "h1", "h2")
    closed = (strings_.join(twice, ["o", "h1", "h2"]).join(unsure.select("c", "low", "high"), "c").where("o between low and high")
              .select("c", F.col("o").alias("low"), F.col("o").alias("high")))
    spans = judged.where("not open").select("c", "low", "high").union(closed)
    placed = (seen.select("doc", "tag", "at", "key", "h1", "h2").join(contexts.select("key", "h1", "h2", "c"), ["key", "h1", "h2"]).join(spans, "c")
              .groupBy("doc", "tag").agg(F.collect_list((F.col("at") - F.col("high"))).alias("starts"),
                                         F.collect_list(F.col("at") - F.col("low") + SIZE).alias("ends")))
    whole = (docs.select("doc", "tag").join(copies.where("n > 1").select("tag").distinct(), "tag").distinct()
             .select("doc", "tag", F.lit(True).alias("whole"), F.lit(None).cast("array<bigint>").alias("starts"), F.lit(None).cast("array<bigint>").alias("ends")))
    return placed.select("doc", "tag", F.lit(False).alias("whole"), "starts", "ends").union(whole)


def remove_repeated_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``carry``, by default all) with ``kept`` (binary), ``n_bytes``, ``n_removed`` and ``n_spans`` appended.

    Each byte covered by a 200-byte string that also starts anywhere else, in any
    text, goes. Texts are UTF-8 bytes; null is empty; strings never cross texts.
    Repeated rows are copies and lose all strings of 200 bytes; ids only carry over. Columns named like
    the new ones are replaced; an empty table stays empty.
    """
    added = ("kept", "n_bytes", "n_removed", "n_spans")
    cols = [c for c in carry or docs.columns if c.lower() not in added]
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The text itself travels once, under its own name.
    read = [*cols, *([] if text_col in cols else [text_col])]
    keyed = docs.select(*read, F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)).alias("__doc"), F.xxhash64(text).alias("__tag"))
    plain = keyed.select(F.col("__doc").alias("doc"), F.col("__tag").alias("tag"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with ExitStack() as done:
        found = stage(repeated_spans(plain, done).groupBy("doc", "tag").agg(
            F.max("whole").alias("whole"), F.first("starts", True).alias("starts"), F.first("ends", True).alias("ends")), "repeats")
    found = found.withColumnsRenamed({c: f"__{c}" for c in found.columns})
    marked = hash_filter(found.select(F.xxhash64("__doc", "__tag").alias("h")), "h")
    probe = keyed.withColumn("__h", F.xxhash64("__doc", "__tag"))
    schema = docs.select(*cols).schema.add("kept", "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")

    def finish(batch: pa.RecordBatch, whole: list | None, starts: list | None, ends: list | None) -> pa.RecordBatch:
        offsets, data = utf8(batch.column(text_col))
        kept, removed, spans = [], [], []
        for i in range(batch.num_rows):
            own = data[offsets[i]:offsets[i + 1]]
            gone = np.zeros(len(own) + 1, np.int64)
            if whole is not None and whole[i]:
                gone[0], gone[-1] = (1, -1) if len(own) >= SIZE else (0, 0)
            elif starts is not None and starts[i]:
                np.add.at(gone, np.array(starts[i]), 1)
                np.add.at(gone, np.array(ends[i]), -1)
            mask = np.cumsum(gone[:-1]) > 0
            kept.append(own[~mask].tobytes())
            removed.append(int(mask.sum()))
            spans.append(int((mask & ~np.concatenate([[False], mask[:-1]])).sum()) if len(own) else 0)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(kept, pa.binary()), pa.array(np.diff(offsets)),
                                           pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], [*cols, *added])

    def split(keep: bool):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            hit = maybe_in(marked, batch.column("__h").to_numpy(zero_copy_only=False).view(U64))
            batch = batch.filter(pa.array(hit == keep))
            return batch if keep or not batch.num_rows else finish(batch, None, None, None)
        return run

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        return finish(batch, *(batch.column(k).to_pylist() for k in ("__whole", "__starts", "__ends")))
    # Texts that may lose bytes meet their spans in a join; the others are not shuffled.
    touched = map_slices(probe, text_col, split(True), probe.schema, SLICE)
    touched = touched.join(found, ["__doc", "__tag"], "left").select(*read, "__whole", "__starts", "__ends")
    return map_slices(probe, text_col, split(False), schema, SLICE).union(map_slices(touched, text_col, cut, schema, SLICE))
