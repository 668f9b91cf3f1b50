"""Derived views over the driver tables, in DataFrame form and as SQL text.

The DataFrame builders are what the registered queries read; the SQL twins are
the CTEs of the DuckDB oracles.  Invalid and missing values come from key
arithmetic, so every view grows with the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ dirty
DIRTY_SQL = """dirty AS (
  SELECT CASE WHEN l_orderkey % 11 = 0 THEN '?' ELSE l_returnflag END AS target,
         CASE WHEN l_orderkey % 13 = 0 THEN 'w' WHEN l_partkey % 7 = 0 THEN NULL
              ELSE CAST(l_quantity AS VARCHAR) END AS feat1,
         CASE WHEN l_suppkey % 3 <> 0 THEN NULL ELSE l_discount END AS feat2,
         CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_extendedprice END AS feat3,
         CASE WHEN l_partkey = 1 THEN 'rare' WHEN l_suppkey % 9 = 0 THEN NULL
              ELSE l_linestatus END AS feat4
  FROM lineitem)"""

DIRTY_DUP_SQL = DIRTY_SQL + """,
dirty_dup AS (
  SELECT * FROM dirty
  UNION ALL
  SELECT CASE WHEN l_orderkey % 11 = 0 THEN '?' ELSE l_returnflag END,
         CASE WHEN l_orderkey % 13 = 0 THEN 'w' WHEN l_partkey % 7 = 0 THEN NULL
              ELSE CAST(l_quantity AS VARCHAR) END,
         CASE WHEN l_suppkey % 3 <> 0 THEN NULL ELSE l_discount END,
         CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_extendedprice END,
         CASE WHEN l_partkey = 1 THEN 'rare' WHEN l_suppkey % 9 = 0 THEN NULL
              ELSE l_linestatus END
  FROM lineitem WHERE l_orderkey % 5 = 0)"""

DIRTY_NUMERIC = ["feat1", "feat2", "feat3"]
DIRTY_CATEGORICAL = ["feat4"]
DIRTY_LABELS = ["A", "N", "R"]
LUMP_THRESHOLD = 40


def _dirty_cols(li: DataFrame) -> DataFrame:
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")
    return li.select(
        F.when(k % 11 == 0, F.lit("?")).otherwise(F.col("l_returnflag")).alias("target"),
        F.when(k % 13 == 0, F.lit("w")).when(p % 7 == 0, null_s)
        .otherwise(F.col("l_quantity").cast("string")).alias("feat1"),
        F.when(s % 3 != 0, null_d).otherwise(F.col("l_discount")).alias("feat2"),
        F.when(p % 10 == 0, null_d).otherwise(F.col("l_extendedprice")).alias("feat3"),
        F.when(p == 1, F.lit("rare")).when(s % 9 == 0, null_s)
        .otherwise(F.col("l_linestatus")).alias("feat4"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty_cols(table(spark, sf_dir, "lineitem"))


def dirty_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return _dirty_cols(li).unionByName(_dirty_cols(li.where(F.col("l_orderkey") % 5 == 0)))


# ------------------------------------------------------------------ clf / scored / sig
CLF_SQL = """clf AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_quantity AS f1, l_extendedprice AS f2, l_discount AS f3, l_tax AS f4,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y
  FROM lineitem)"""

SCORED_SQL = """scored AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         l_extendedprice / 105000e0 AS score
  FROM lineitem)"""

SIG_SQL = """sig AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_quantity AS f1, l_extendedprice AS f2, l_discount AS f3, l_tax AS f4,
         CASE WHEN l_partkey % 10 = 0
              THEN (CASE WHEN l_quantity * l_discount > 2e0 THEN 0 ELSE 1 END)
              ELSE (CASE WHEN l_quantity * l_discount > 2e0 THEN 1 ELSE 0 END) END AS label
  FROM lineitem)"""

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = ["f1", "f2", "f3", "f4"]


def clf(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*KEYS, F.col("l_quantity").alias("f1"), F.col("l_extendedprice").alias("f2"),
                     F.col("l_discount").alias("f3"), F.col("l_tax").alias("f4"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*KEYS, F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
                     (F.col("l_extendedprice") / F.lit(105000.0)).alias("score"))


def sig(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    big = F.col("l_quantity") * F.col("l_discount") > 2.0
    label = F.when(F.col("l_partkey") % 10 == 0, F.when(big, 0).otherwise(1)) \
        .otherwise(F.when(big, 1).otherwise(0))
    return li.select(*KEYS, F.col("l_quantity").alias("f1"), F.col("l_extendedprice").alias("f2"),
                     F.col("l_discount").alias("f3"), F.col("l_tax").alias("f4"),
                     label.alias("label"))


# ------------------------------------------------------------------ emb / doc / geo
EMB_SQL = """emb AS (
  SELECT vec_id, """ + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)) + """,
         CASE WHEN label < 5 THEN 1 ELSE 0 END AS label
  FROM embeddings)"""
EMB_FEATURES = [f"e{i}" for i in range(64)]


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}")
                                for i in range(64)],
                    F.when(F.col("label") < 5, 1).otherwise(0).alias("label"))


DOC_SQL = """doc AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # labels covers a subset of documents: the join is an equi-join on the key;
    # the smaller side is broadcast by Catalyst's own size statistics.
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


GEO_SQL = """geo AS (
  SELECT c_custkey,
         CAST((c_custkey % 180) - 90 AS DOUBLE) AS lat1,
         CAST((c_custkey * 7 % 360) - 180 AS DOUBLE) AS lon1,
         CAST((c_nationkey % 180) - 90 AS DOUBLE) AS lat2,
         CAST((c_nationkey * 7 % 360) - 180 AS DOUBLE) AS lon2
  FROM customer)"""


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    return c.select("c_custkey",
                    ((k % 180) - 90).cast("double").alias("lat1"),
                    ((k * 7 % 360) - 180).cast("double").alias("lon1"),
                    ((nk % 180) - 90).cast("double").alias("lat2"),
                    ((nk * 7 % 360) - 180).cast("double").alias("lon2"))


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
