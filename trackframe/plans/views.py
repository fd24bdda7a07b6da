"""Adapters that present the driver's test tables as tracker respondents.

Each adapter is a plain DataFrame plan over the parquet tables (column pruning
and filters reach the scans). The matching DuckDB SQL lives next to it in
``trackframe.plans.oracle`` so both engines derive the same rows.

Joins carry no hints: Catalyst broadcasts a side only when its statistics
(parquet file sizes) are under ``spark.sql.autoBroadcastJoinThreshold``, so
the 25-row ``nation`` x ``region`` lookup is broadcast while ``orders`` x
``customer`` becomes a sort-merge join once ``customer`` outgrows the
threshold, and AQE re-plans either from runtime sizes.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession, functions as F


# One resolved relation per (session, table): listing the files and reading the
# footers costs ~0.1 s on the driver per read, and the test tables are read-only.
_RELATIONS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table (read-only parquet), resolved once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _RELATIONS.setdefault(spark, {})
    if path not in known:
        known[path] = spark.read.parquet(path)
    return known[path]


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")


def _orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = _geo(spark, sf_dir)
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(geo, F.col("c_nationkey") == geo.n_nationkey))


def _key_mod(m: int):
    return F.col("o_orderkey") % m == 0


def orders_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as typed canonical respondent rows (waves 1..7 = order years 1995..2001)."""
    k = F.col("o_orderkey")
    return _orders_base(spark, sf_dir).select(
        k.cast("string").alias("respondent_id"),
        (F.year("o_orderdate") - 1994).cast("int").alias("wave"),
        F.col("o_orderdate").cast("date").cast("string").alias("fieldwork_date"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("age_group"),
        F.when(~_key_mod(17), F.col("o_totalprice") / 100000.0).alias("weight"),
        F.when(~_key_mod(13), ((k * 7) % 11).cast("int")).alias("nps_score"),
        F.when(~_key_mod(19), (1 + (k * 3) % 5).cast("int")).alias("satisfaction"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
         .cast("int").alias("aware"),
        F.col("c_mktsegment").alias("brand_used"),
    )


def orders_tracker_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as text, with deliberate contract violations.

    nps '99' (key % 97 = 0), weight '-1' (% 89), satisfaction '7' (% 83),
    aware '2' (% 79), no respondent id (% 101), wave 'x' (% 103). A row can
    break several rules, which exercises the reason priority.
    """
    t = orders_tracker(spark, sf_dir)
    k = F.col("respondent_id").cast("bigint")

    def dirty(col: str, m: int, bad):
        return F.when(k % m == 0, bad).otherwise(F.col(col).cast("string")).alias(col)

    return t.select(
        F.when(k % 101 != 0, F.col("respondent_id")).alias("respondent_id"),
        dirty("wave", 103, F.lit("x")),
        "fieldwork_date", "region", "age_group",
        dirty("weight", 89, F.lit("-1")),
        dirty("nps_score", 97, F.lit("99")),
        dirty("satisfaction", 83, F.lit("7")),
        dirty("aware", 79, F.lit("2")),
        "brand_used",
    )


def events_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as respondents: wave = day of month, segment = event_type, weight = value."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        F.col("event_id").cast("string").alias("respondent_id"),
        F.dayofmonth("ts").cast("int").alias("wave"),
        F.col("event_type"),
        F.col("value").alias("weight"),
        (F.col("user_id") % 11).cast("int").alias("nps_score"),
        (1 + F.col("event_id") % 5).cast("int").alias("satisfaction"),
        (F.col("user_id") % 2).cast("int").alias("aware"),
    )


def document_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, weighted by length, with their 0/1 quality and toxic flags (null where not labelled)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("weight"), "quality", "toxic")
