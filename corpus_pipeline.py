"""Corpus pipeline: language, near copies, repeated passages, benchmark leaks, packing.

Each stage reads the documents that the one before kept and writes its own as
Parquet in the shared folder, so a lost executor costs at most one stage's tasks. All
but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.llm.catalog import tokenizer_path
from trackframe.llm.decontam import contaminated, row_key
from trackframe.llm.langid import UND, fit_languages, predict_languages
from trackframe.llm.packing import pack
from trackframe.llm.recompress import remove_repeats
from trackframe.llm.simhash import simhash_least
from trackframe.llm.staging import stage, table


def _fresh(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _shielded(docs: DataFrame, taken: tuple[str, ...]) -> tuple[DataFrame, list]:
    """``docs`` with columns of the ``taken`` names renamed, and the selection that gives its own columns back."""
    names = {c: _fresh(docs, f"__own_{c}") for c in docs.columns if c.lower() in taken}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts in a language the model knows; texts without a letter (or null) go. The model learns from all of ``docs``.

    Without any labelled text there is no language to go by: every text with a letter stays.
    """
    model = fit_languages(docs)
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
    shielded, own = _shielded(docs, ("lang_pred", "score"))
    return predict_languages(shielded, model).where(F.col("lang_pred") != UND).select(*own)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str, *, unique_ids: bool = True) -> DataFrame:
    """Keep one document of each group linked by fingerprints of 3-word shingles at 3 bits or fewer.

    It is that of the smallest id, by text hash among rows that repeat the id; a
    document without an id stays if its group has no id at all. So every group
    keeps exactly one row, whatever the ids. With ``unique_ids`` an id that stands
    for several groups keeps only the row with the smallest text hash.
    """
    # Equal rows have equal keys, so any of them will do; nulls are told from the hash's skipped values.
    marks = F.concat(*[F.col(c).isNull().cast("string") for c in docs.columns])
    key = {"__none": F.col("doc_id").isNull(), "__id": F.col("doc_id"), "__text": F.xxhash64("text"), "__all": F.xxhash64(marks, *docs.columns)}
    own = docs.select("doc_id", "text", *[c.alias(_fresh(docs, k)) for k, c in key.items()])
    first = simhash_least(own, F.struct(*[F.col(_fresh(docs, k)).alias(k) for k in key]), shingle=3, radius=3)
    if unique_ids:
        named = first.where("not __none").groupBy("__id").agg(F.min(F.struct("__text", "__all")).alias("__row"))
        first = first.where("__none").select("__text", "__all").union(named.select("__row.*"))
    hashes = {k: _fresh(docs, k) for k in ("__text", "__all")}
    # Partial aggregates leave one of equal rows in each task; the join uses the same partitioning.
    rows = docs.select("*", *[key[k].alias(h) for k, h in hashes.items()]).groupBy(*hashes.values()).agg(*[F.first(c).alias(c) for c in docs.columns])
    kept = first.select(*[F.col(k).alias(h) for k, h in hashes.items()])
    return rows.join(kept, list(hashes.values()), "left_semi").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut word runs of 13 or more that a document of a smaller id holds; a text that loses nothing stays as it is.

    A document of which nothing remains goes.
    """
    shielded, own = _shielded(docs, ("kept", "n_words", "n_removed"))
    cut = remove_repeats(shielded)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    left = cut.where((F.col("n_removed") == 0) | (F.col("kept") != "")).withColumn("text", text)
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*own)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, its values changed or not.

    Rows are told apart by id and text: others of the same id, or without one, stay.
    """
    key = _fresh(docs, "__found")
    found = contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select(F.col("row").alias(key)).distinct()
    return docs.withColumn(key, row_key()).join(stage(found, "contaminated"), key, "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into windows of 1024 ids; one row per piece, with its ids.

    The encoder gets less memory here than alone: executors still hold what earlier stages left.
    """
    return pack(docs, tokenizer_path(), keep_ids=True, size=1 << 20, kept_pieces=150_000)


STAGES = [
    ("language_id", language),
    ("simhash_neardup", partial(near_copies, unique_ids=False)),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]

# SQL expresses none of the learned, iterative and tokenizing stages: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
