"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .bestfit import pack_best_fit
from .decontam import contaminated
from .fingerprint import WIDE, edited_fingerprints
from .htmltext import extract_pages
from .langid import fit_languages, predict_languages
from .negatives import hard_negatives
from .packing import pack
from .recompress import remove_repeats
from .simhash import simhash_groups
from .staging import scratch_path, table
from .suffixdedup import remove_repeated_bytes
from .tokenfile import read_token_file, token_digests, write_token_file
from .toxicity import fit_toxicity, score_toxicity
from .whitening import whiten


def _remainder(column: str, by: int):
    """crc32 of the id as text, modulo ``by``; a null id counts as remainder -1 (never held out)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % by, F.lit(-1))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "n_windows", "coverage", "changed")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_bytes(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-file")
    write_token_file(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_digests(read_token_file(spark, path))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"), fraction=WIDE)


def op6_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(_remainder("doc_id", 5) != 0)
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.where(_remainder("doc_id", 4) != 2))
    predicted = predict_languages(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"), scale=64, components=16)
    return white.select("vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", "explained", "identity_error")


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_html_text": op3_html_text,
    "op4_token_file": op4_token_file,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash_neardup": op6_simhash_neardup,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_best_fit": op12_best_fit,
    "op13_hard_negatives": op13_hard_negatives,
}

# DuckDB SQL for the queries that SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {}
