"""Lexical retrieval packing into fixed windows.

Documents are brought together by their rarest shared terms: the key of a document
lists its token ids from rare to common by their document counts over the whole
table, and the table is dealt and sorted by it, so documents that share a rare term (or,
where many do, also the next ones) follow one another. Shards are bounded
runs in that order. Each shard has a BM25 inverted index over token ids; a
seed document is followed by its best unused neighbours, which greedily fill its window. A document that does not fit is cut, and its rest
opens the next window as the new seed. So windows are full but for the
shard's last one, which is cut at powers of two (these need no padding).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .staging import stage, unstage
from .textops import give_back, map_batches, ragged, slices, utf8
from .tokens import encoder

WINDOW = 1024
END_ID = 0
K1, B = 1.2, 0.75
# Ids of a shard (2 to 4 MB of text); one document counts as half of them at most, so none is alone for its length.
SHARD_IDS = 1 << 20
KEY_TERMS = 8
# Neighbours ranked at a time.
RANKED = 64
# Text encoded at once and pieces a process keeps: time against memory, the ids are the same.
ENCODED_BYTES, PIECES = 3 << 20, 1_000_000
NAMES = ["doc_id", "ids", "high", "counts"]


def _ranks(x: np.ndarray) -> np.ndarray:
    """Stable sorting order of small whole numbers; 16 bits are enough for most and sort in linear time."""
    return np.argsort(x.astype(np.uint16) if not len(x) or x.max() < 1 << 16 else x, kind="stable")


class Index:
    """BM25 over one shard; documents are given by their ids and bounds."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        n = len(bounds) - 1
        lengths = np.diff(bounds)
        doc = np.repeat(np.arange(n, dtype=np.uint64), lengths)
        code = np.sort(ids.astype(np.uint64) * np.uint64(n) + doc)
        heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        tf = np.diff(np.concatenate([heads, [len(code)]]))
        term, self.doc = (code[heads] // np.uint64(n)).astype(np.int64), (code[heads] % np.uint64(n)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        self.starts = np.concatenate([cut, [len(term)]])
        self.df = np.diff(self.starts)
        slot = np.repeat(np.arange(len(cut)), self.df)
        idf = np.log1p((n - self.df + 0.5) / (self.df + 0.5))
        norm = K1 * (1 - B + B * lengths[self.doc] / max(1.0, lengths.mean()))
        self.weight = idf[slot] * tf * (K1 + 1) / (tf + norm)
        # Each document's terms, those of its own alone left out.
        shared = np.flatnonzero(self.df[slot] > 1)
        order = shared[_ranks(self.doc[shared])]
        self.terms, self.own = slot[order], np.searchsorted(self.doc[order], np.arange(n + 1))
        # Terms of over a quarter of the documents are rows of a matrix (four entries a posting at most), faster to add up than lists.
        common = np.flatnonzero(4 * self.df > n)
        self.line = np.full(len(self.df), -1, np.int64)
        self.line[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), n))
        in_matrix = self.line[slot] >= 0
        self.matrix[self.line[slot[in_matrix]], self.doc[in_matrix]] = self.weight[in_matrix]
        self._keep(~in_matrix)

    def _keep(self, kept: np.ndarray) -> None:
        """Reduce the lists to the postings marked in ``kept``."""
        before = np.concatenate([[0], np.cumsum(kept)])
        self.starts, self.doc, self.weight = before[self.starts], self.doc[kept], self.weight[kept]
        self.df = np.diff(self.starts)

    def neighbours(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term with ``seed``, by the BM25 sum over all shared terms, best first, ties by position.

        Ranks are made ``RANKED`` at a time, as most seeds need few of them.
        """
        query = self.terms[self.own[seed]:self.own[seed + 1]]
        at = ragged(self.starts[query], self.df[query])
        total = np.bincount(self.doc[at], self.weight[at], len(used)) if len(at) else np.zeros(len(used))
        lines = self.line[query]
        total += self.matrix[lines[lines >= 0]].sum(axis=0)
        total[used] = 0
        found = np.flatnonzero(total > 0)
        score = total[found]
        while len(found) > RANKED:
            least = np.partition(score, len(score) - RANKED)[len(score) - RANKED]
            first = score >= least  # with all that tie with the last of them
            yield from found[first][np.argsort(-score[first], kind="stable")].tolist()
            found, score = found[~first], score[~first]
        yield from found[np.argsort(-score, kind="stable")].tolist()

    def forget(self, used: np.ndarray) -> None:
        """Take used documents off the lists; nothing else about the remaining ones changes."""
        self._keep(~used[self.doc])


def order(ids: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> list[int]:
    """Documents of a shard in packing order."""
    n = len(bounds) - 1
    if not n:
        return []
    index, used, out = Index(ids, bounds), np.zeros(n, bool), []
    lengths = np.diff(bounds).tolist()
    fresh, seed, room, listed = 0, -1, 0, n
    while True:
        if n - len(out) < 0.7 * listed:
            listed = n - len(out)
            index.forget(used)
        if seed < 0:
            while fresh < n and used[fresh]:
                fresh += 1
            if fresh == n:
                return out
            seed, room = fresh, window if room == 0 else room
            used[seed] = True
            out.append(seed)
            room = (room - lengths[seed]) % window
            if room == 0:
                seed = -1
                continue
        following = -1
        for d in index.neighbours(seed, used):
            used[d] = True
            out.append(d)
            if lengths[d] >= room:  # fills the window; a rest of it seeds the next one
                rest = lengths[d] - room
                room = (window - rest) % window
                following = d if room else -1
                break
            room -= lengths[d]
        seed = following


def pieces(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, start, length, sequence, offset)`` of the pieces of documents laid end to end.

    Cuts fall at every ``window`` ids; what remains at the end is cut into powers of two.
    """
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    cuts = list(range(0, total - total % window, window))
    at, rest = total - total % window, total % window
    while rest:
        cuts.append(at)
        at += 1 << (rest.bit_length() - 1)
        rest = total - at
    cuts_ = np.array(cuts, np.int64)
    begins = np.unique(np.concatenate([cuts_, ends - lengths]))
    begins = begins[begins < total]
    size = np.diff(np.concatenate([begins, [total]]))
    doc = np.searchsorted(ends, begins, "right")
    sequence = np.searchsorted(cuts_, begins, "right") - 1
    return doc, begins - (ends - lengths)[doc], size, sequence, begins - cuts_[sequence]


def halves(ids: np.ndarray) -> tuple[bytes, bytes | None]:
    """The low 16 bits of ids, and the high ones if any is not zero (no vocabulary of up to 65,536 ids needs them)."""
    low, high = ids.astype("<u2"), (ids >> np.uint32(16)).astype("<u2")
    return low.tobytes(), high.tobytes() if high.any() else None


def _shorts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 16-bit numbers of a binary column, and where each row's begin."""
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    values = np.frombuffer(data, "<u2") if data is not None and data.size else np.zeros(0, "<u2")
    return values[offsets[0] // 2:offsets[-1] // 2], (offsets - offsets[0]) // 2


def from_halves(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, bounds)`` of the columns ``ids`` and ``high`` made by ``halves``."""
    low, bounds = _shorts(batch.column("ids"))
    ids = low.astype(np.uint32)
    high = batch.column("high")
    if high.null_count < len(high):
        rows = np.flatnonzero(high.is_valid().to_numpy(zero_copy_only=False))
        upper, _ = _shorts(high)  # a null row has none
        ids[ragged(bounds[rows], np.diff(bounds)[rows])] |= upper.astype(np.uint32) << np.uint32(16)
    return ids, bounds


def _terms(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(doc, id)`` of the distinct ids of each document, ascending."""
    code = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64) << np.uint64(32), np.diff(bounds)) | ids.astype(np.uint64)
    code.sort()
    if len(code):
        code = code[np.concatenate([[True], code[1:] != code[:-1]])]
    return (code >> np.uint64(32)).astype(np.int64), (code & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], most: int = SHARD_IDS) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a partition, across its batches, of about ``most`` ids; a row counts as half of it at most."""
    held, size = [], 0
    for batch in batches:
        counts = np.diff(_shorts(batch.column("ids"))[1])
        ends = np.cumsum(np.minimum(counts, most // 2))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = min(batch.num_rows, int(np.searchsorted(ends, done + most - size, "left")) + 1)
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - done
            at = to
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID, size: int = ENCODED_BYTES, pieces: int = PIECES) -> DataFrame:
    """``(doc_id, ids, high, counts)``: ids of each whole ``text`` and its end id, as ``halves``.

    Each task adds a row of its own that has no ids, but ``counts``: ids and in how many of its documents each is.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text", size):
                ids, bounds = encoder(tokenizer, pieces).encode(*utf8(part.column("text")))
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                found = np.bincount(_terms(ids, bounds)[1], minlength=len(total))
                found[:len(total)] += total
                total = found
                rows = [halves(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                low, high = (pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), low, high, pa.nulls(len(rows), pa.binary())], NAMES)
                del ids, bounds, found, rows, part
            kind = batch.schema.field("doc_id").type
            del batch
            give_back()
        if len(total):
            term = np.flatnonzero(total)
            counts = np.stack([term, total[term]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([counts], pa.binary())], NAMES)
    return map_batches(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, high binary, counts binary")


def neighbourly(coded: DataFrame, terms: int = KEY_TERMS) -> DataFrame:
    """``coded``, a staged table that is removed, dealt and sorted by each document's rarest ids that another document of the table has too.

    Document counts are one number per id of the vocabulary. Rows of equal
    keys are ordered by the hash of their ids and spread over tasks like others.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("counts"):
                term, n = np.frombuffer(row.as_py(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], ["term", "n"])
    counts = map_batches(coded.select("counts").where("counts is not null"), count, "term bigint, n bigint")
    counts = counts.groupBy("term").agg(F.sum("n").alias("n")).where("n > 1")
    common = sorted((r["n"], r["term"]) for r in counts.collect())  # at most the vocabulary
    rank = np.full(max((t for _, t in common), default=-1) + 2, 0xFFFFFFFF, np.uint32)  # the last place is for all other ids
    for i, (_, t) in enumerate(common):
        rank[t] = i
    spec = coded.sparkSession.sparkContext.broadcast(rank)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = spec.value
        for batch in _blocks(batches):
            ids, bounds = from_halves(batch)
            doc, place = _terms(rank[np.minimum(ids, len(rank) - 1)], bounds)
            nth = np.arange(len(doc)) - np.searchsorted(doc, doc, "left")
            kept = (nth < terms) & (place < 0xFFFFFFFF)
            cuts = 4 * np.concatenate([[0], np.cumsum(np.bincount(doc[kept], minlength=batch.num_rows))]).astype(np.int32)
            key = pa.Array.from_buffers(pa.binary(), batch.num_rows,
                                        [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(place[kept].astype(">u4").tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns, key], [*batch.schema.names, "key"])
            give_back()
    kind = coded.schema["doc_id"].dataType.simpleString()
    keyed = map_batches(coded.where("counts is null").select("doc_id", "ids", "high"), keys, f"doc_id {kind}, ids binary, high binary, key binary").select(
        "*", F.xxhash64("ids", "high").alias("tie"), F.monotonically_increasing_id().alias("copy"))
    # Written once: the range bounds are sampled from the stored key columns alone.
    keyed = stage(keyed, "keyed")
    unstage(coded)
    spec.destroy()
    order = ["key", "tie", "doc_id", "copy"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids", "high")


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, keep_ids: bool = False, size: int = ENCODED_BYTES, kept_pieces: int = PIECES) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    Every id of every document, with its end id, is in exactly one piece. A shard is
    a run of rows in the order of ``neighbourly``, about ``SHARD_IDS`` ids. Null and
    empty texts are just the end id; rows with null or equal ids are packed like
    others; extra columns are ignored; an empty table gives no rows. ``size`` and ``kept_pieces`` bound the memory of
    the encoding and change no result.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    coded = stage(encoded(chosen, tokenizer, end_id, size, kept_pieces), "encoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 40
        for rows in _blocks(batches):
            ids, bounds = from_halves(rows)
            chain = np.array(order(ids, bounds, window), np.int64)
            place, start, length, number, offset = pieces(np.diff(bounds)[chain], window)
            doc = chain[place]
            first = bounds[doc] + start
            crc = [zlib.crc32(ids[a:a + k]) for a, k in zip(first.tolist(), length.tolist())]
            out = [rows.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                   pa.array(np.diff(bounds)[doc]), pa.array(sequence + number), pa.array(offset)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                cuts = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids[ragged(first, length)].astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)
            sequence += int(number[-1]) + 1
            del ids, chain, out, rows
            give_back()
    schema = (f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, "
              "doc_tokens bigint, sequence_id bigint, offset bigint" + (", ids array<int>" if keep_ids else ""))
    return map_batches(neighbourly(coded), run, schema)
