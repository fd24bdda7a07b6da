"""Document fingerprints: threshold-scaled shingle sketches, built-in functions only.

The sketch of a text is the set of its word-shingle hashes below a fixed
fraction of the hash space, so its size follows the text. The share of the
smaller sketch found in the larger one estimates containment even between very
unequal texts; the fewer hashes it has, the rougher the estimate.
A text without a hash below the threshold has its smallest hash for a sketch.
Sketches of parts merge by union, where a hash above the threshold only counts if
there is none below (``merge_sketches``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

SHINGLE = 5
FRACTION = 1 / 16
# op5's own fraction: short texts need a wide one to keep some hashes.
WIDE = 1 / 2
# Order buckets: at most QUANTILES x STEPS, of about BUCKET_ROWS documents while the table allows.
QUANTILES, STEPS, BUCKET_ROWS = 4096, 16, 256


def shingle_hashes(words: str, shingle: int = SHINGLE) -> Column:
    """Hash of every run of ``shingle`` entries of an array of words (fewer: of all of them; none: no hashes)."""
    return F.expr(f"case when size({words}) = 0 then array() else "
                  f"transform(sequence(1, greatest(size({words}) - {shingle - 1}, 1)), i -> xxhash64(slice({words}, i, {shingle}))) end")


def _limit(fraction: float) -> int:
    return int(-(1 << 63) + fraction * (1 << 64))


def merge_sketches(a: str, b: str, fraction: float = FRACTION) -> Column:
    """The sketch of the union of two texts' shingles: hashes below the threshold, or the least hash if there is none."""
    both, limit = f"array_sort(array_union({a}, {b}))", _limit(fraction)
    return F.expr(f"case when array_min({both}) < {limit}L then filter({both}, h -> h < {limit}L) else slice({both}, 1, 1) end")


def with_sketch(df: DataFrame, text: str, out: str, *, shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """``df`` with the sorted array of kept hashes of column ``text`` as ``out``."""
    words, hashes = f"__{out}_words", f"__{out}_hashes"
    limit = _limit(fraction)
    df = df.withColumn(words, F.expr(f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"))
    df = df.withColumn(hashes, shingle_hashes(words, shingle).cast("array<bigint>"))
    return df.withColumn(out, F.expr(
        f"case when size({hashes}) = 0 then cast(array() as array<bigint>) else "
        f"array_sort(array_distinct(concat(array(array_min({hashes})), filter({hashes}, h -> h < {limit}L)))) end"
    )).drop(words, hashes)


def sketch_text(sketch: str) -> Column:
    """A sketch as one string, 16 hex digits a hash."""
    return F.expr(f"lower(array_join(transform({sketch}, h -> lpad(hex(h), 16, '0')), ''))")


def likeness(a: str, b: str) -> Column:
    """Share of the smaller sketch that the other holds; two empty sketches are alike (1), an empty one is like no other (0)."""
    return F.expr(f"case when size({a}) = 0 and size({b}) = 0 then 1D when size({a}) = 0 or size({b}) = 0 then 0D "
                  f"else size(array_intersect({a}, {b})) / cast(least(size({a}), size({b})) as double) end")


def with_next(df: DataFrame, id_col: str, columns: list[str], tie: str) -> DataFrame:
    """``df`` with ``next_<c>`` for each of ``columns``: the values of the row that follows in descending id order.

    The last row is followed by the first. Null ids come last; equal ids are
    ordered by ``tie``. Rows are dealt by id range: quantiles of the ids, each cut into
    equal steps, so a task holds one short range whatever the ids are. The
    first row of each range is also sent to the range before it. The list of
    ranges is broadcast; it has at most QUANTILES x STEPS rows.
    """
    size = df.agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).first()
    n, lo, hi = size["n"], size["lo"], size["hi"]
    if lo is None:
        lo = hi = 0
    parts = max(1, min(QUANTILES, n // (BUCKET_ROWS * STEPS)))
    inner = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        inner = df.agg(F.percentile_approx(id_col, shares, 10 * QUANTILES).alias("q")).first()["q"]
    edges = sorted({lo, *inner}) + [hi + 1]
    bounds = F.array(*[F.lit(int(e)).cast("bigint") for e in edges])
    df = df.withColumn("__b", F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(
        F.array_size(F.filter(bounds, lambda x: x <= F.col(id_col)))))
    low, high = F.get(bounds, F.col("__b") - 1), F.get(bounds, F.col("__b"))
    step = F.floor((F.col(id_col) - low).cast("double") * STEPS / (high - low).cast("double"))
    df = df.withColumn("__k", (F.col("__b") * STEPS + F.coalesce(F.least(step, F.lit(STEPS - 1)), F.lit(0))).cast("bigint")).drop("__b")
    # At most QUANTILES x STEPS ranges. The first row of the first range goes to the last one.
    ranges = df.groupBy("__k").agg(F.max(id_col).alias("__first"))
    heads = ranges.select(
        F.col("__k").alias("__hk"), "__first",
        F.coalesce(F.lag("__k").over(Window.orderBy(F.desc("__k"))), F.min("__k").over(Window.partitionBy())).alias("__before"))
    dealt = df.join(F.broadcast(heads), (F.col("__k") == F.col("__hk")) & F.col("__first").eqNullSafe(F.col(id_col)), "left")
    targets = F.when(F.col("__before").isNull(), F.array(F.struct(F.col("__k").alias("k"), F.lit(0).alias("extra")))).otherwise(
        F.array(F.struct(F.col("__k").alias("k"), F.lit(0).alias("extra")),
                F.struct(F.col("__before").alias("k"), F.lit(1).alias("extra"))))
    # Plain columns and one projection for all leads: the range key's exchange then serves them all.
    dealt = dealt.withColumn("__t", F.explode(targets)).withColumns({"__range": F.col("__t.k"), "__extra": F.col("__t.extra")})
    order = Window.partitionBy("__range").orderBy("__extra", F.col(id_col).desc_nulls_last(), tie)
    leads = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    kept = [c for c in df.columns if c != "__k"]
    return dealt.select(*kept, "__extra", *leads).where("__extra = 0").drop("__extra")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE,
                        fraction: float = FRACTION) -> DataFrame:
    """Fingerprint of each whole text and of its edited text, one row per input row.

    The edited text replaces the last floor(n/2) code points by as many first
    ones (or all) of the next document in descending id order. Null texts count
    as empty (fingerprint ""); repeated ids stay, ordered by the hash of their text; extra
    columns are ignored; a single document is its own next; an empty table
    gives no rows. Likenesses are those of the fingerprints returned (``near_next``: of this row's and the next one's).
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = with_sketch(base, "text", "sketch", shingle=shingle, fraction=fraction).withColumn("tie", F.xxhash64("text"))
    rows = with_next(base, "doc_id", ["text", "sketch"], "tie")
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    rows = rows.withColumn("edited", F.expr(
        "concat(left(text, cast(n_chars - n_chars div 2 as int)), left(next_text, cast(n_chars div 2 as int)))"))
    rows = with_sketch(rows, "edited", "edited_sketch", shingle=shingle, fraction=fraction)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch_text("sketch").alias("fingerprint"), sketch_text("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"), likeness("sketch", "next_sketch").alias("near_next"))
