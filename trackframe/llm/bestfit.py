"""Hierarchical best-fit packing into fixed windows.

The tasks that encode the texts pack their own pieces by best fit, longest first. Bins
that are nearly full are final. The others travel on as indivisible items: Spark deals them
by hash into groups of bounded size, each group is packed again, and so on up a tree whose
levels shrink, until one group is left or a round no longer saves bins. A bin carries its
members' places, so no later join is needed, and no task holds more than one group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .staging import stage
from .textops import map_batches, ragged, slices, utf8
from .tokens import _KINDS, NUMBER, SPACE, Encoder, distinct

WINDOW = 2048
END_ID = 0
# A bin with at most this many free places is final.
SLACK = 8
# Pieces that an encoding task packs at once, and bins that a later task packs.
BLOCK, GROUP = 1 << 16, 1 << 12
# A round that saves less than this part of its bins is the last one.
SAVING = 0.002
# Pieces a process keeps, and text it encodes at once.
PIECES, SLICE = 600_000, 4 << 20


class WordEncoder(Encoder):
    """Ids of whole texts for a lower-casing tokenizer whose pieces are letter runs, single digits, contractions
    and runs of other characters, white space dropped. Unusual texts go to the library whole, as in ``Encoder``.
    """

    def _simple(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        dotted = np.flatnonzero(data[:-1] == 0xC4)  # U+0130 becomes two characters in lower case
        dotted = dotted[data[dotted + 1] == 0xB0]
        simple = super()._simple(offsets, data)
        simple[np.searchsorted(offsets, dotted, "right") - 1] = False
        return simple

    def _cut(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(starts, kinds, lower)``: first byte of each piece or white space, what each byte is, ASCII in lower case."""
        n = len(data)
        lower = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        kind = _KINDS[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            code = ((data[lead].astype(np.int32) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
            kind[lead] = kind[lead + 1] = _KINDS[np.minimum(code, 0x23F)]
        start = (kind == NUMBER) & ((data & 0xC0) != 0x80)
        start[1:] |= kind[1:] != kind[:-1]
        start[offsets[:-1][offsets[:-1] < n]] = True
        quote = np.flatnonzero((data == 39) & start)
        if len(quote):
            ends = offsets[np.searchsorted(offsets, quote, "right")]
            pad = np.concatenate([lower, np.zeros(3, np.uint8)])
            a, b = pad[quote + 1], pad[quote + 2]
            one = np.isin(a, np.frombuffer(b"stmd", np.uint8)) & (quote + 2 <= ends)
            two = (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)) & (quote + 3 <= ends)
            for hit, size in ((quote[one], 2), (quote[two], 3)):
                start[hit + 1] = False
                start[(hit + size)[hit + size < n]] = True
        return np.flatnonzero(start), kind, lower

    def _encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, kind, lower = self._cut(offsets, data)
        sizes, solid = np.diff(np.concatenate([starts, [len(data)]])), kind[starts] != SPACE
        starts, sizes = starts[solid], sizes[solid]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(lower[kind != SPACE].tobytes())]).dictionary_encode()
        raw, pieces = distinct(coded)
        if (raw >= 0x80).any():
            text = raw.tobytes()
            lowered = [p if p.isascii() else p.decode().lower().encode() for p in (text[a:b] for a, b in zip(pieces.tolist(), pieces[1:].tolist()))]
            raw, pieces = np.frombuffer(b"".join(lowered), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in lowered])])
        index = self._numbers(raw, pieces)[coded.indices.to_numpy()]
        first, count = self.starts[index], self.starts[index + 1] - self.starts[index]
        total = np.concatenate([[0], np.cumsum(count)])
        return self.flat[ragged(first, count)], total[np.searchsorted(starts, offsets)]


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path, PIECES)
    return _encoders[path]


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bin, offset, fills)``: each item, longest first, goes to the open bin it leaves least room in.

    Open bins are listed by their room; the bits of one integer tell which rooms have a bin.
    """
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        where[i], offset[i] = b, capacity - room
        room -= size
        fills[b] = capacity - room
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
    return where, offset, np.array(fills, np.int64)


def _gathered(columns: list[pa.Array], names: list[str], where: np.ndarray, fills: np.ndarray, first: int) -> pa.RecordBatch:
    """Bins ``first, first + 1, ...`` of member columns (their ``offset`` included), given each member's bin."""
    order = pa.array(np.argsort(where, kind="stable"))
    cuts = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(fills)))]).astype(np.int32)
    members = pa.StructArray.from_arrays([c.take(order) for c in columns], names)
    return pa.RecordBatch.from_arrays([pa.array(first + np.arange(len(fills))), pa.array(fills, pa.int32()),
                                       pa.ListArray.from_arrays(pa.array(cuts), members)], ["bin", "fill", "members"])


def _first_bin(level: int) -> int:
    """Bin numbers of a task start here: distinct for every level and partition."""
    from pyspark import TaskContext

    return level << 57 | TaskContext.get().partitionId() << 35


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "offset"]


def _packed_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int, schema: str) -> DataFrame:
    """Encode texts and pack the pieces of each task (in blocks of about ``BLOCK``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, many = _first_bin(0), [], 0
        code = word_encoder(tokenizer)

        def flush():
            nonlocal number, held, many
            columns = [pa.concat_arrays([h[0] for h in held]), *[np.concatenate([h[k] for h in held]) for k in range(1, 5)]]
            where, offset, fills = best_fit(columns[3], window)
            out = _gathered([columns[0], pa.array(columns[1], pa.int32()), *map(pa.array, columns[2:]), pa.array(offset)], NAMES, where, fills, number)
            number, held, many = number + len(fills), [], 0
            return out
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, bounds = code.encode(*utf8(part.column("text")))
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                tokens = np.diff(bounds)
                count = -(-tokens // window)
                doc = np.repeat(np.arange(len(tokens)), count)
                piece = ragged(np.zeros(len(count), np.int64), count)
                start = piece * window
                length = np.minimum(window, tokens[doc] - start)
                begin = (bounds[:-1][doc] + start).tolist()
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = np.array([zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(begin, length.tolist())], np.int64)
                held.append((part.column("doc_id").take(pa.array(doc)), piece, start, length, crc))
                many += len(doc)
                if many >= BLOCK:
                    yield flush()
        if many:
            yield flush()
    return map_batches(docs, run, schema)


def _repacked(bins: DataFrame, level: int, window: int, schema: str) -> DataFrame:
    """Pack each partition's bins as items; members keep their order, at new offsets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        where, offset, fills = best_fit(rows.column("fill").to_numpy().astype(np.int64), window)
        lists = rows.column("members")
        count = np.diff(lists.offsets.to_numpy())
        members = lists.flatten()
        columns = [members.field(n) for n in NAMES]
        columns[-1] = pa.array(columns[-1].to_numpy() + np.repeat(offset, count))
        yield _gathered(columns, NAMES, np.repeat(where, count), fills, _first_bin(level))
    return map_batches(bins, run, schema)


def pack_best_fit(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  end_id: int = END_ID, slack: int = SLACK) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A text's ids and its end id are one piece, or pieces of ``window`` ids and a
    last shorter one. Pieces are packed whole, so that a sequence holds at most ``window`` ids from
    offset 0 on without gaps. Null and empty texts are just the end id; rows with null or equal
    ids are packed like others; equal sizes are taken in their order; an empty table gives no
    rows; extra columns are ignored. The tokenizer must cut texts as ``WordEncoder`` does.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = (f"bin bigint, fill int, members array<struct<doc_id: {kind}, piece: int, start: bigint, length: bigint, "
              "ids_crc32: bigint, offset: bigint>>")
    bins = stage(_packed_pieces(chosen, tokenizer, window, end_id, schema), "bins")
    final, level = [], 0
    full = F.col("fill") >= window - slack
    left = bins.where(~full).count()
    while left > 1:
        level += 1
        final.append(bins.where(full))
        groups = -(-left // GROUP)
        dealt = bins.where(~full).repartition(groups, F.xxhash64("bin"))
        bins = stage(_repacked(dealt, level, window, schema), f"bins-{level}")
        counted = bins.agg(F.count(F.lit(1)).alias("n"), F.count_if(~full).alias("open")).first()
        saved, left = left - counted["n"], counted["open"]
        if groups == 1 or saved < SAVING * (saved + counted["n"]):
            break
    final.append(bins)
    every = final[0]
    for more in final[1:]:
        every = every.union(more)
    return every.select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m")).select(
        *[F.col(f"m.{n}").alias(n) for n in NAMES[:-1]], "sequence_id", F.col("m.offset").alias("offset"))
