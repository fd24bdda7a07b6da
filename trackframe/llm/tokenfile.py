"""Token-id files compressed by Re-Pair grammars.

A file is a table of shards, written by Spark's own Parquet writer (so a lost
task is simply written again). A shard holds consecutive documents in id order:
their ids and lengths, the grammar's rules, each rule's expansion length, the
symbol stream, and the running expansion length at every ``STEP``-th symbol, which
lets a reader decode any range of ids without expanding what comes before it.

Re-Pair works in rounds: count all adjacent pairs of the shard, give the most
frequent ones a nonterminal each, replace them left to right, and repeat until no
pair is frequent enough.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from .textops import map_batches, ragged, slices, utf8
from .tokens import encoder

FIRST = 1 << 16  # the first nonterminal; vocabularies are smaller
RULES, LEAST = 4096, 12  # most rules of a round, least count of a pair
STEP = 1024
END_ID = 2
# Text of a shard, and pieces a process keeps: larger shards repeat more pieces and pairs.
SHARD_BYTES = 6 << 20
PIECES = 1_000_000

SCHEMA = ("part int, shard int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, rules binary, "
          "expansions binary, symbols binary, marks binary")


def repair(ids: np.ndarray, most: int = RULES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(symbols, rules, expansions)``; rule k is nonterminal FIRST + k and stands for its two symbols."""
    x = ids.astype(np.uint32)
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    # Whether the pair that begins here can be frequent. One that was not in the round before never will be: its count only falls.
    live = np.ones(len(x), bool)
    while len(x) > 1:
        spots = np.flatnonzero(live[:-1])
        pair = x[spots].astype(np.uint64) << np.uint64(32) | x[spots + 1]
        ordered = np.sort(pair)
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else spots
        counts = np.diff(np.concatenate([heads, [len(ordered)]]))
        often = np.flatnonzero(counts >= least)
        if not len(often):
            break
        frequent = ordered[heads[often]]
        taken = np.zeros(len(often), bool)
        taken[np.argsort(-counts[often], kind="stable")[:most]] = True
        # A table by hash finds most of them; pairs that meet another one in their slot are searched.
        slot = lambda p: ((p * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        table = np.full(1 << 20, -1, np.int32)
        table[slot(frequent)] = np.arange(len(frequent))
        where = table[slot(pair)]
        at = np.flatnonzero(where >= 0)
        pair, where = pair[at], where[at]
        good = frequent[where] == pair
        other = np.flatnonzero(~good)
        where[other] = np.minimum(np.searchsorted(frequent, pair[other]), len(frequent) - 1)
        good[other] = frequent[where[other]] == pair[other]
        at, where = spots[at[good]], where[good]
        live[:] = False
        live[at] = True
        at, where = at[taken[where]], where[taken[where]]
        # Overlapping places follow one another: every second one of such a run stays, from its start.
        first = np.concatenate([[True], np.diff(at) != 1])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        even = (np.arange(len(at)) - begin) % 2 == 0
        at, where = at[even], where[even]
        base, chosen = FIRST + len(rules), frequent[taken]
        left, right = (chosen >> np.uint64(32)).astype(np.uint32), (chosen & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        size = lambda s: np.where(s < FIRST, 1, np.concatenate([lengths, [0]])[np.maximum(s.astype(np.int64) - FIRST, 0)])
        lengths = np.concatenate([lengths, (size(left) + size(right)).astype(np.uint32)])
        rules = np.concatenate([rules, np.stack([left, right], axis=1)])
        x[at] = (base + np.cumsum(taken) - 1)[where].astype(np.uint32)
        live[np.maximum(at - 1, 0)] = True
        kept = np.ones(len(x), bool)
        kept[at + 1] = False
        x, live = x[kept], live[kept]
    return x, rules, lengths


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    starts = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    flat = np.zeros(int(starts[-1]), np.uint32)
    for k, (a, b) in enumerate(rules.tolist()):  # rules only use earlier ones
        at = int(starts[k])
        for s in (a, b):
            if s < FIRST:
                flat[at] = s
                at += 1
            else:
                n = int(lengths[s - FIRST])
                flat[at:at + n] = flat[starts[s - FIRST]:starts[s - FIRST] + n]
                at += n
    kind = symbols >= FIRST
    rule = np.where(kind, symbols.astype(np.int64) - FIRST, 0)
    count = np.where(kind, lengths[rule] if len(lengths) else 1, 1).astype(np.int64)
    table = np.concatenate([flat, symbols[~kind]])
    begin = np.zeros(len(symbols), np.int64)
    begin[kind] = starts[rule[kind]]
    begin[~kind] = len(flat) + np.arange(int((~kind).sum()))
    return table[ragged(begin, count)]


def decode_range(shard: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of one shard row, expanding only the symbols around them."""
    symbols, rules = np.frombuffer(shard["symbols"], "<u4"), np.frombuffer(shard["rules"], "<u4").reshape(-1, 2)
    lengths, marks = np.frombuffer(shard["expansions"], "<u4"), np.frombuffer(shard["marks"], "<i8")
    if stop <= start:
        return np.zeros(0, np.uint32)
    low = int(np.searchsorted(marks, start, "right")) - 1
    high = int(np.searchsorted(marks, stop, "left"))
    ids = expand(symbols[low * STEP:high * STEP], rules, lengths)
    return ids[start - int(marks[low]):stop - int(marks[low])]


def _shard(part: int, number: int, doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    symbols, rules, lengths = repair(ids)
    sizes = np.ones(len(symbols), np.int64)
    sizes[symbols >= FIRST] = lengths[symbols[symbols >= FIRST] - FIRST]
    marks = np.concatenate([[0], np.cumsum(sizes)])[:-1][::STEP]
    one = lambda v, t: pa.array([v], t)
    return pa.RecordBatch.from_arrays(
        [one(part, pa.int32()), one(number, pa.int32()), one(doc_ids.to_pylist(), pa.list_(pa.int64())),
         one(np.diff(bounds), pa.list_(pa.int64())), one(len(ids), pa.int64()),
         *(one(v.tobytes(), pa.binary()) for v in (rules.astype("<u4"), lengths.astype("<u4"), symbols.astype("<u4"), marks.astype("<i8")))],
        [f.split()[0] for f in SCHEMA.split(", ")])


def write_token_file(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                     end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id``, and write the shards in ascending id order.

    Null and empty texts are just the end id. Null ids come first; rows with
    equal ids follow one another, ordered by the hash of their text. An empty table
    writes a file without shards.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = chosen.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, part = 0, TaskContext.get().partitionId()
        with np.errstate(over="ignore"):
            for batch in batches:
                for rows in slices(batch, "text", SHARD_BYTES):
                    ids, bounds = encoder(tokenizer, PIECES).encode(*utf8(rows.column("text")))
                    ends = np.insert(ids, bounds[1:], end_id)
                    yield _shard(part, number, rows.column("doc_id"), ends, bounds + np.arange(len(bounds)))
                    number += 1
    map_batches(ordered, run, SCHEMA).write.parquet(path)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """The shards of a file, with ``start``: ids of all shards before."""
    shards = spark.read.parquet(path)
    # Two levels of running sums: over partitions, then over a partition's shards.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    sizes = shards.select("part", "shard", "n_ids").join(before, "part")
    inner = Window.partitionBy("part").orderBy("shard")
    starts = sizes.select("part", "shard", (F.col("before") + F.sum("n_ids").over(inner) - F.col("n_ids")).alias("start"))
    return shards.join(starts, ["part", "shard"])


def token_digests(shards: DataFrame) -> DataFrame:
    """Decode shards: one row per document, ``doc_id, start, n_tokens, ids_crc32``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in ("symbols", "rules", "expansions", "marks", "n_ids", "start")}
                ids = decode_range(row, 0, row["n_ids"]).astype("<u4")
                lengths = batch.column("lengths")[i].values.to_numpy()
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values.cast(pa.int64()), pa.array(row["start"] + ends - lengths), pa.array(lengths),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
    needed = shards.select("doc_ids", "lengths", "n_ids", "rules", "expansions", "symbols", "marks", "start")
    return map_batches(needed, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
