"""Array helpers for text columns: byte views of Arrow columns, word bounds, string hashes, sliding windows.

Everything works on one bounded slice of an Arrow batch at a time, so the
memory of a task follows ``SLICE_BYTES`` (or its longest single text), not the
size of its partition.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Text handled at once by a task, in bytes.
SLICE_BYTES = 2 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits (wraps modulo 2**64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_codes(seed: int) -> np.ndarray:
    """A 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=U64) * U64(_BASE) + U64(seed))


_CODES = {seed: byte_codes(seed) for seed in (1, 2)}
_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse; kept and grown per process."""
    global _powers, _inverses
    if len(_powers) <= n:
        size = -(-(n + 1) // (1 << 18)) << 18
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.r_[U64(1), np.full(size, _BASE, U64)])
            _inverses = np.cumprod(np.r_[U64(1), np.full(size, _INVERSE, U64)])
    return _powers, _inverses


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Sums of ``codes[i] * base**i``; ``span_hash`` reads the hash of any span from them."""
    out = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * powers(len(codes))[0][:len(codes)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the codes in each span, the same wherever the span lies."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


def byte_prefix(data: np.ndarray, seed: int = 1) -> np.ndarray:
    return prefix_hash(_CODES[seed][data])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, data)`` of a string column; offsets start at 0, a null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    view = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], view[offsets[0]:offsets[-1]]


def characters(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, code points)`` of the texts ``utf8`` gives; bytes that are no UTF-8 become U+FFFD."""
    raw = data.tobytes()
    try:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets], points
    except UnicodeDecodeError:
        texts = [raw[a:b].decode(errors="replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        return np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]), points


_tables: dict[str, np.ndarray] = {}


def character_table(name: str, of: Callable[[str], int], kind=bool) -> np.ndarray:
    """``of`` every character of the basic plane, made once a process."""
    if name not in _tables:
        _tables[name] = np.fromiter((of(chr(i)) for i in range(1 << 16)), kind, 1 << 16)
    return _tables[name]


def lower_points(points: np.ndarray) -> np.ndarray:
    """Lower-cased code points, where the lower case is one character of the basic plane."""
    table = character_table("lower", lambda c: ord(c.lower()) if len(c.lower()) == 1 else ord(c), np.uint32)
    return np.where(points < len(table), table[np.minimum(points, len(table) - 1)], points)


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of a batch with about ``size`` bytes of text each, at least one row."""
    if not batch.num_rows:
        return
    ends = utf8(batch.column(text))[0][1:]
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(at, to - at)
        at = to


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that they need no installed copy."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="trackframe-code-")) / "trackframe.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted((root / "trackframe").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()
    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, text: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema,
               size: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over bounded slices of the text column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in slices(batch, text, size):
                    out = fn(part)
                    del part
                    if out is not None and out.num_rows:
                        yield out
                    del out
                del batch
                give_back()
    return map_batches(df, run, schema)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of True; runs never cross the texts' bounds in ``offsets``."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = offsets[(offsets > 0) & (offsets < n)]
    first = member.copy()
    first[1:] &= ~member[:-1]
    first[inner] = member[inner]
    last = member.copy()
    last[:-1] &= ~member[1:]
    last[inner - 1] = member[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, bounds)`` of the words ``[^\\x20\\x09-\\x0D]+``; text i owns words bounds[i]..bounds[i+1]."""
    starts, ends = runs(~_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` consecutive entries, by windows of doubled width."""
    if len(x) < width:
        return x[:0]
    span = 1
    while 2 * span <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i], starts[i]+1, ...`` (``lengths[i]`` of them), one list after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
