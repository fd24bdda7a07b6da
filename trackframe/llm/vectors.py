"""Embedding vectors as integers: floor(scale * entry) of each vector, as compact binary rows.

A vector whose integers all fit in 16 bits takes two bytes an entry, any other
eight, so equal vectors have equal bytes and can be grouped as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .textops import map_batches

# Integers of a magnitude beyond this are not exact in the arithmetic below; such entries count as non-finite.
LARGEST = 1 << 52


def _rows(column: pa.Array, scale: float) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """``(usable row numbers, their bytes, their lengths)`` of a list-of-double column."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(flat * scale)
        bad = ~(np.abs(whole) < LARGEST)
    ends = np.cumsum(lengths)
    count = np.concatenate([[0], np.cumsum(bad)])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0) & (count[ends] == count[ends - lengths])
    whole[bad] = 0
    wide = np.concatenate([[0], np.cumsum(np.abs(whole) >= 1 << 15)])
    narrow = wide[ends] == wide[ends - lengths]
    small, large = whole.astype("<i2"), whole.astype("<i8")
    out, keep = [], np.flatnonzero(usable)
    for a, b, fits in zip((ends - lengths)[keep].tolist(), ends[keep].tolist(), narrow[keep].tolist()):
        out.append((small if fits else large)[a:b].tobytes())
    return keep, out, lengths[keep]


def integer_vectors(df: DataFrame, vector: str, scale: float) -> DataFrame:
    """The other columns of ``df``, ``dim int`` and ``x binary`` of every row with a usable vector.

    A null or empty vector, or one with a null, non-finite or excessive (``LARGEST``) entry, is not usable.
    """
    rest = [c for c in df.columns if c != vector]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest] + ["dim int", "x binary"])

    def run(batches):
        for batch in batches:
            keep, raw, dims = _rows(batch.column(vector), scale)
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in rest], pa.array(dims, pa.int32()), pa.array(raw, pa.binary())],
                                             [*rest, "dim", "x"])
    return map_batches(df.select(*rest, F.col(vector).cast("array<double>").alias(vector)), run, schema)


def main_dimension(coded: DataFrame) -> int | None:
    """The length most vectors have (of equally frequent ones the longest); None without a vector."""
    row = coded.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    return row["dim"] if row else None


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """The int64 matrix of a binary column whose vectors all have ``dim`` entries."""
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    view = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    narrow = sizes == 2 * dim
    if narrow.all():
        return view.view("<i2").reshape(-1, dim).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    at = offsets[:-1] - offsets[0]
    for i in range(len(column)):
        out[i] = view[at[i]:at[i] + sizes[i]].view("<i2" if narrow[i] else "<i8")
    return out
