"""Membership filters over 64-bit hashes, sized by their number, built by Spark and sent to every task.

A filter may say yes to a hash that is not in it, never no to one that is: callers
use it to spare work only, and join or count exactly afterwards. It has 16 slots a
hash or more, up to ``MOST_BITS``; where that is under eight slots a hash there
is no filter, and callers semi-join on the key instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from .textops import U64, map_batches

# A filter is 32 MB at most, whatever the data: good for some 33 million hashes.
LEAST_BITS, MOST_BITS = 16, 28
_PIECE = 16  # slots per collected piece, as a power of two


def _second(hashes: np.ndarray) -> np.ndarray:
    return hashes * U64(0x9E3779B97F4A7C15)


def filter_bits(n: int) -> int | None:
    """Size of a filter of ``n`` hashes as a power of two; None if it would be too large to send."""
    if 8 * n > 1 << MOST_BITS:
        return None
    return max(LEAST_BITS, min(MOST_BITS, (16 * n).bit_length()))


def hash_filter(hashes: DataFrame, column: str) -> Broadcast | None:
    """Broadcast ``(bits, packed slots)`` of a bigint column of a stored table; nulls are left out. None if they are too many."""
    bits = filter_bits(hashes.count())
    if bits is None:
        return None
    shift = 64 - bits

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).view(U64)
            with np.errstate(over="ignore"):
                s = np.unique(np.concatenate([h >> U64(shift), _second(h) >> U64(shift)])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(s >> _PIECE), pa.array((s & ((1 << _PIECE) - 1)).astype(np.int32))],
                                             ["piece", "slot"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.column("slots"):
                marks = np.zeros(1 << _PIECE, bool)
                marks[row.values.to_numpy()] = True
                out.append(np.packbits(marks, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("piece"), pa.array(out, pa.binary())], ["piece", "bits"])
    found = map_batches(hashes.select(F.col(column).cast("bigint")).dropna(), slots, "piece bigint, slot int")
    pieces = found.groupBy("piece").agg(F.collect_set("slot").alias("slots"))
    table = np.zeros((1 << bits) >> 3, np.uint8)
    size = (1 << _PIECE) >> 3
    for row in map_batches(pieces, packed, "piece bigint, bits binary").collect():  # 2**bits / 8 bytes at most
        table[row["piece"] * size:(row["piece"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast((bits, table))


def maybe_in(spec: Broadcast | None, hashes: np.ndarray) -> np.ndarray:
    """Whether each uint64 hash may be in the filter; all may where there is none."""
    if spec is None:
        return np.ones(len(hashes), bool)
    bits, table = spec.value
    out = np.ones(len(hashes), bool)
    for h in (hashes, _second(hashes)):
        slot = (h >> U64(64 - bits)).astype(np.int64)
        out &= (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
    return out


def release(spec: Broadcast | None) -> None:
    """Free a filter that no task will ask again."""
    if spec is not None:
        spec.destroy()


def stand_ins(known: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows of ``known(doc, tag, ..)`` that stand for all copies of their text, ``least`` of ``copies(tag, least)``: the way without a filter."""
    return known.join(copies.select("tag", F.col("least").alias("doc")).distinct(), ["tag", "doc"], "left_semi").select(*known.columns)


def with_keys(known: DataFrame, pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """``known(doc, tag, ..)`` rows that have a key of ``shared(key)``, with those as ``keys``: the way without a filter.

    ``pairs(doc, tag, key)`` are all keys of each text. A key that very many texts
    hold is only ever a join key, split by AQE; a text has no more keys than bytes.
    """
    lists = pairs.join(shared.select("key"), "key", "left_semi").groupBy("doc", "tag").agg(F.collect_set("key").alias("keys"))
    return known.join(lists, ["doc", "tag"]).select(*known.columns, "keys")


def has_key(spec: Broadcast | None, batch: pa.RecordBatch, hashes: np.ndarray) -> np.ndarray:
    """Whether each uint64 hash may be a shared key: by the filter, or by the ``keys`` that ``with_keys`` gave the rows."""
    if spec is not None:
        return maybe_in(spec, hashes)
    return np.isin(hashes, batch.column("keys").flatten().to_numpy(zero_copy_only=False).view(U64))
