"""Audit frames over the given tables, and the same frames as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to a fixed number of digits, so that the order of summation does not show."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Frame A: binary decisions about documents."""
    return table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id").select(
        F.col("doc_id").alias("row_key"), F.col("quality").alias("target"),
        F.when(F.col("n_chars") < 1500, 1).otherwise(0).alias("prediction"), "lang", "source", "toxic", "n_chars",
    )


A = """a AS (
  SELECT d.doc_id AS row_key, l.quality AS target, CASE WHEN d.n_chars < 1500 THEN 1 ELSE 0 END AS prediction,
         d.lang AS lang, d.source AS source, l.toxic AS toxic, d.n_chars AS n_chars
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def returns(spark: SparkSession, folder: str) -> DataFrame:
    """Frame B: three classes, two dimensions."""
    q = F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("target"),
        F.when(q < 17, "A").when(q < 34, "N").otherwise("R").alias("prediction"),
        F.col("l_linestatus").alias("status"), F.col("l_linenumber").alias("line"),
    )


B = """b AS (
  SELECT l_returnflag AS target, CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS prediction,
         l_linestatus AS status, l_linenumber AS line
  FROM lineitem)"""


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Frame C: orders with everything known about the customer."""
    return (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_orderkey").alias("row_key"), F.when(F.col("o_totalprice") > 200000, 1).otherwise(0).alias("target"),
            "c_acctbal", "o_totalprice", "c_mktsegment", "o_orderpriority", "o_orderstatus", "r_name", "n_nationkey",
            "o_orderdate", "c_custkey",
        )
    )


C = """c AS (
  SELECT o_orderkey AS row_key, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS target, c_acctbal, o_totalprice,
         c_mktsegment, o_orderpriority, o_orderstatus, r_name, n_nationkey, o_orderdate, c_custkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

KEYS = ["c_mktsegment", "o_orderpriority", "o_orderstatus"]


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """Frame D: decisions in time."""
    return with_decision(table(spark, folder, "events"))


def with_decision(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("grp"), "value", "props",
        F.when(F.col("value") > 50, 1).otherwise(0).alias("target"),
        F.when(F.col("user_id") % 3 == 0, 1).otherwise(0).alias("prediction"),
    )


D = """d AS (
  SELECT event_id, ts, user_id, event_type AS grp, value, props, CASE WHEN value > 50 THEN 1 ELSE 0 END AS target,
         CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS prediction
  FROM events)"""


def voxels(spark: SparkSession, folder: str) -> DataFrame:
    """Frame E: each vector as a volume of 8 by 8 voxels in one slice per position."""
    long = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("patient"), "label", F.posexplode("embedding").alias("pos", "raw")
    )
    p = F.col("prob")
    return long.withColumn("prob", F.col("raw").cast("double")).select(
        "patient", "label", "pos", (F.col("pos") % 8).alias("x"), F.floor(F.col("pos") / 8).cast("int").alias("y"),
        F.lit(0).alias("z"), "prob",
        F.when(p > 0.1, 1).otherwise(0).alias("pred"),
        F.when((p > 0.05) & (F.col("pos") % 4 != 0), 1).otherwise(0).alias("truth"),
    )


V = """w AS (
  SELECT vec_id AS patient, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS prob FROM embeddings),
v AS (
  SELECT patient, label, pos, CAST(pos % 8 AS INTEGER) AS x, CAST(pos // 8 AS INTEGER) AS y, 0 AS z, prob,
         CASE WHEN prob > 0.1 THEN 1 ELSE 0 END AS pred,
         CASE WHEN prob > 0.05 AND pos % 4 <> 0 THEN 1 ELSE 0 END AS truth
  FROM w)"""

SCORES = """s AS (
  SELECT patient, any_value(label) AS label, CAST(sum(pred) AS BIGINT) AS volume,
         coalesce(avg(CASE WHEN pred = 1 THEN prob END), 0.0) AS confidence,
         coalesce(2.0 * sum(pred * truth) / nullif(sum(pred) + sum(truth), 0), 0.0) AS dice,
         coalesce(1.0 * sum(pred * truth) / nullif(sum(pred) + sum(truth) - sum(pred * truth), 0), 0.0) AS jaccard
  FROM v GROUP BY patient)"""
