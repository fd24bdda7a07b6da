"""Intermediate tables in the shared folder, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.session import drop_path, scratch_path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove the files of a table made by ``stage`` that nothing will read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop_path(df.sparkSession, folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the smallest node reachable.

    Alternating large-star / small-star rounds until no edge changes: each
    round is one min-aggregate and one join per star, rows never exceed the
    edges, and a node with very many edges is only ever a join key (split by
    AQE) and a partially aggregated group.
    """
    flat = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, before = stage(flat, "edges"), None
    for _ in range(max_rounds):
        state = tuple(current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first())
        if state == before or not state[0]:
            break
        before = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        following = stage(small, "edges")
        unstage(current)
        current = following
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.groupBy("u").agg(F.min("v").alias("root"))
    return (roots.select(F.col("u").alias("node"), "root")
            .union(roots.select(F.col("root").alias("node"), "root").distinct()))
