"""Sources and sinks: the given tables through a sink and back through its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.catalog.enforcement import AUDIT, audit
from equigauge.catalog.frames import rounded, table
from equigauge.catalog.registry import registry
from equigauge.operators.frames import pending
from equigauge.session import shared_folder
from equigauge.sources import sinks, tables

QUERIES, ORACLES, registered = registry()


@registered("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = shared_folder(spark, "csv")
    sinks.write_delimited(rows, path)
    return tables.read_delimited(spark, path, rows.schema)


@registered("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A table written in partitions, twice, as a rerun would."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = shared_folder(spark, "table")
    for _ in range(2):
        sinks.write_table(rows, path, ["o_orderstatus"])
    return tables.conform(tables.read_table(spark, path), rows.schema)


@registered(f"WITH {AUDIT} SELECT control_id, metric_key, round(v, 6) AS actual_value, operator, threshold, passed, severity FROM res")
def results_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Results of an audit, one row per control, as one JSON document and back."""
    fields = ["control_id", "description", "metric_key", "actual_value", "threshold", "operator", "passed", "severity"]
    path = shared_folder(spark, "results")
    sinks.write_json(audit(spark, folder).agg(F.collect_list(F.struct(*fields)).alias("metrics")), path)
    return rounded(tables.read_results(spark, path).drop("description"))


@registered("SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0")
def resume_append(spark: SparkSession, folder: str) -> DataFrame:
    """What is still to do after a run was stored, and stored again by its rerun."""
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    path = shared_folder(spark, "runs")
    for _ in range(2):
        sinks.append_results(rows.filter("c_custkey % 3 = 0"), path, "run-1")
    return pending(rows, tables.read_table(spark, path), "c_custkey").select(F.col("c_custkey").cast("long"))
