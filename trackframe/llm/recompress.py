"""Removal of long word runs that an earlier document already holds, by recompression.

Each round names runs and pairs of adjacent symbols. A symbol's name is a hash
of what it stands for, so every task gives equal runs and pairs the same name
without a shared dictionary. Pairs are formed by a fixed two-way split of the names
(left symbols with right ones), so inside equal word sequences the same symbols arise,
but for a few at the edges; for each window those edges are tracked exactly and only
its interior symbols, which its words alone determine, are used. The smallest name
of three adjacent interior symbols (two, where there are no three) of the
highest level is the window's anchor.

Anchors met in more than one document reveal candidate windows; these are
compared by 96-bit hashes of their words and the smallest id that holds each window is found.
"""

from __future__ import annotations

from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .hashfilter import has_key, hash_filter, maybe_in, release, stand_ins, with_keys
from .staging import stage, unstage
from .textops import U64, byte_prefix, map_batches, map_slices, mix, prefix_hash, span_hash, utf8, words

WINDOW = 13
ROUNDS = 2
LAST = (1 << 63) - 1
# Text handled at once: several arrays of eight bytes a byte are alive at a time.
SLICE = 1 << 20


def parse(names: np.ndarray, bounds: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS):
    """Yield ``(level, symbols, first, last)``: each window's interior symbols are ``symbols[first:last]``.

    ``names`` are word hashes, ``bounds`` the texts' word offsets; windows are
    those of ``window_starts``.
    """
    low = window_starts(bounds, window)
    high = low + window
    yield 0, names, low, high
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    x = names
    for level in range(1, rounds + 1):
        if level == 1:
            # Runs: the outermost of a window may go on outside it, so they never count as interior.
            head = np.ones(len(x), bool)
            head[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
            number = np.cumsum(head) - 1
            at = np.flatnonzero(head)
            size = np.diff(np.concatenate([at, [len(x)]])).astype(U64)
            x, doc = np.where(size == 1, x[at], mix(x[at] * U64(3) + size)), doc[at]
            low, high = number[low] + 1, number[high - 1]
            high = np.maximum(low, high)
        side = (mix(x + U64(level)) >> U64(17)) & U64(1)  # 0: left, 1: right
        pad = np.concatenate([side, [U64(0)]])
        joined = np.zeros(len(x), bool)
        joined[:-1] = (side[:-1] == 0) & (side[1:] == 1) & (doc[:-1] == doc[1:])
        # At a window's edge a right symbol may belong to one before it, a left symbol to one after it.
        low = low + ((low < high) & (pad[low] == 1))
        high = high - ((low < high) & (pad[high - 1] == 0))
        head = np.ones(len(x), bool)
        head[1:] = ~joined[:-1]
        number = np.cumsum(head) - 1
        at = np.flatnonzero(head)
        follow = np.concatenate([x, [U64(0)]])[at + 1]
        pair = joined[at]
        number = np.concatenate([number, [len(at)]])
        full = low < high
        first = number[low]
        high = np.where(full, number[high - 1] + 1, first)
        low = first
        x, doc = np.where(pair, mix(x[at] * U64(5) + mix(follow)), x[at]), doc[at]
        yield level, x, low, high


def window_starts(bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Word index of each window, text by text."""
    counts = np.maximum(np.diff(bounds) - window + 1, 0)
    total = int(counts.sum())
    return np.arange(total) + np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts)


def anchors(names: np.ndarray, bounds: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> np.ndarray:
    """Each window's anchor: the least name of adjacent interior symbols of the highest level, of three rather than two."""
    out = None
    for level, x, low, high in parse(names, bounds, window, rounds):
        if out is None:
            out = np.zeros(len(low), U64)
        grams = x
        for size in (2, 3):
            grams = mix(grams[:-1] * U64(7) + mix(x[size - 1:] + U64(level)))
            have = high - low >= size
            if not have.any():
                break
            padded = np.concatenate([grams, np.full(size, np.iinfo(U64).max)])
            a, b = low[have], high[have] - size + 1
            new = np.ones(len(a), bool)  # neighbouring windows often share their interior
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            least = np.minimum.reduceat(padded, np.stack([a[new], b[new]], axis=1).ravel())[::2]
            out[have] = least[np.cumsum(new) - 1]
    return out


def _names(batch: pa.RecordBatch, seed: int = 1):
    offsets, data = utf8(batch.column("text"))
    starts, ends, bounds = words(offsets, data)
    return span_hash(byte_prefix(data, seed), starts, ends), bounds


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def twin_filter(docs: DataFrame):
    """Filter of the ids that several rows share; only their places need to say which text they are of."""
    ids = stage(docs.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.xxhash64("doc").alias("h")), "twins")
    twins = hash_filter(ids, "h")
    unstage(ids)
    return twins


def _high(twins, ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Upper half of the text hash for rows whose id is shared, else 0; ``ids`` are hashed ids."""
    return np.where(maybe_in(twins, ids.view(U64)), tags >> 32, 0)


def repeated_windows(docs: DataFrame, twins, done: ExitStack, window: int = WINDOW) -> DataFrame:
    """``(doc, high, whole, places)`` of the texts with words to remove.

    ``docs`` has ``doc`` (id order key), ``tag`` (text hash) and ``text``.
    ``places`` are first words of windows that a smaller ``doc`` holds; ``whole``
    marks a copy of a smaller document's text, whose windows all are such;
    ``high`` tells texts of one id apart. ``done`` gets what to clear when the result is written.
    """
    copies = stage(docs.groupBy("tag", F.md5(F.col("text").cast("binary")).alias("sum")).agg(F.min("doc").alias("least"), F.max("doc").alias("most")), "texts")
    # The first document of each text stands for all of them. A copy that passes this filter is only judged twice.
    stands = hash_filter(copies.select(F.xxhash64("tag", "least").alias("h")), "h")
    known = docs.select("doc", "tag", "text", F.xxhash64("tag", "doc").alias("h"), F.xxhash64("doc").alias("id"))
    done.callback(unstage, copies)
    done.callback(release, stands)
    if stands is None:
        known = stage(stand_ins(known, copies), "stand-ins")
        done.callback(unstage, known)

    def first_only(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(maybe_in(stands, _column(batch, "h").view(U64))))

    def find(batch: pa.RecordBatch, owners: bool = False) -> pa.RecordBatch | None:
        batch = first_only(batch)
        names, bounds = _names(batch)
        key = anchors(names, bounds, window)
        if not len(key):
            return None
        counts = np.maximum(np.diff(bounds) - window + 1, 0)
        ends = np.cumsum(counts)
        keys = [np.unique(key[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]  # once a text
        found = pa.array(np.concatenate(keys).view(np.int64))
        if not owners:
            return pa.RecordBatch.from_arrays([found], ["key"])
        row = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
        return pa.RecordBatch.from_arrays([batch.column("doc").take(row), batch.column("tag").take(row), found], ["doc", "tag", "key"])
    shared = map_slices(known, "text", find, "key bigint", SLICE).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    shared = stage(shared, "shared")
    common = hash_filter(shared, "key")
    done.callback(unstage, shared)
    done.callback(release, common)
    if common is None:
        owned = map_slices(known, "text", lambda b: find(b, owners=True), "doc bigint, tag bigint, key bigint", SLICE)
        known = stage(with_keys(known, owned, shared), "with-keys")
        done.callback(unstage, known)

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        batch = first_only(batch)
        names, bounds = _names(batch)
        key = anchors(names, bounds, window)
        hit = np.flatnonzero(has_key(common, batch, key))
        if not len(hit):
            return None
        at = window_starts(bounds, window)[hit]
        doc = np.searchsorted(bounds, at, "right") - 1
        h1 = span_hash(prefix_hash(names), at, at + window).view(np.int64)
        h2 = (span_hash(prefix_hash(_names(batch, 2)[0]), at, at + window) >> U64(33)).astype(np.int32)
        high = _high(twins, _column(batch, "id"), _column(batch, "tag"))
        place = (high[doc] << 32) | (at - bounds[:-1][doc])
        return pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(_column(batch, "doc")[doc]), pa.array(place)],
                                          ["h1", "h2", "doc", "place"])
    # Computed twice rather than kept: the candidates are the largest table here, and cheap to find again.
    candidates = map_slices(known, "text", windows, "h1 bigint, h2 int, doc bigint, place bigint", SLICE)
    least = candidates.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    # Stored, so that the join deals both sides anew and AQE can split a window that very many documents hold.
    least = stage(least.select("h1", "h2", "least"), "least")
    done.callback(unstage, least)
    later = candidates.join(least, ["h1", "h2"]).where("doc > least").select(
        "doc", F.shiftright("place", 32).alias("high"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("place"))
    parts = later.groupBy("doc", "high").agg(F.collect_list("place").alias("places")).select(
        "doc", "high", F.lit(False).alias("whole"), "places")

    def upper(batches):
        for b in batches:
            high = pa.array(_high(twins, _column(b, "id"), _column(b, "tag")))
            yield pa.RecordBatch.from_arrays([b.column("doc"), high], ["doc", "high"])
    again = (docs.select("doc", "tag").join(copies.where("least < most").select("tag", "least"), "tag").where("doc > least")
             .select("doc", F.xxhash64("doc").alias("id"), "tag").distinct())
    again = map_batches(again, upper, "doc bigint, high bigint").select(
        "doc", "high", F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("places"))
    return parts.union(again)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   carry: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``carry``, by default all) with ``kept`` (kept words joined by one space), ``n_words`` and ``n_removed`` appended.

    A word goes if a window of ``window`` words over it also starts in a document with a
    smaller id. Null and empty texts have no words. Rows with equal ids do not take
    words from each other; a null id is after all others. Columns named like
    the new ones are replaced; an empty table stays empty.
    """
    added = ("kept", "n_words", "n_removed")
    cols = [c for c in carry or docs.columns if c.lower() not in added]
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The text itself travels once, under its own name.
    read = [*cols, *([] if text_col in cols else [text_col])]
    keyed = docs.select(*read, F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("__doc"), F.xxhash64(text).alias("__tag"))
    plain = keyed.select(F.col("__doc").alias("doc"), F.col("__tag").alias("tag"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    twins = twin_filter(plain)
    with ExitStack() as done:
        found = stage(repeated_windows(plain, twins, done, window).groupBy("doc", "high").agg(
            F.max("whole").alias("whole"), F.first("places", ignorenulls=True).alias("places")), "repeats")
    found = found.withColumnsRenamed({c: f"__{c}" for c in found.columns})
    marked = hash_filter(found.select(F.xxhash64("__doc").alias("h")), "h")
    probe = keyed.withColumn("__h", F.xxhash64("__doc"))
    schema = docs.select(*cols).schema.add("kept", "string").add("n_words", "long").add("n_removed", "long")

    def finish(batch: pa.RecordBatch, places: list | None, whole: list | None) -> pa.RecordBatch:
        kept, counts, removed = [], [], []
        for i, t in enumerate(pc.fill_null(batch.column(text_col), "").to_pylist()):
            parts = t.encode().split()
            n = len(parts)
            if whole is not None and n >= window and (whole[i] or places[i]):
                gone = np.zeros(n + 1, np.int64)
                at = np.array([0], np.int64) if whole[i] else np.unique(np.array(places[i], np.int64))
                gone[at] = 1
                np.add.at(gone, np.minimum(at + window, n), -1)
                mask = np.ones(n, bool) if whole[i] else np.cumsum(gone[:n]) > 0
                parts = [p for p, m in zip(parts, mask.tolist()) if not m]
            kept.append(b" ".join(parts).decode())
            counts.append(n)
            removed.append(n - len(parts))
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in cols), pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
            [*cols, *added])

    def untouched(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        batch = batch.filter(pa.array(~maybe_in(marked, _column(batch, "__h").view(U64))))
        return finish(batch, None, None) if batch.num_rows else None

    def chosen(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        batch = batch.filter(pa.array(maybe_in(marked, _column(batch, "__h").view(U64))))
        high = pa.array(_high(twins, _column(batch, "__h"), _column(batch, "__tag")))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*read, "__doc")), high], [*read, "__doc", "__high"])

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        return finish(batch, batch.column("__places").to_pylist(), batch.column("__whole").to_pylist())
    # Texts that may lose words meet their places in a join; the others are not shuffled.
    touched = map_slices(probe, text_col, chosen, probe.select(*read, "__doc").schema.add("__high", "long"), SLICE)
    touched = touched.join(found, ["__doc", "__high"], "left").select(
        *read, F.coalesce("__whole", F.lit(False)).alias("__whole"), "__places")
    return map_slices(probe, text_col, untouched, schema, SLICE).union(map_slices(touched, text_col, cut, schema, SLICE))
