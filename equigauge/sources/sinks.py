"""Writers: tables, resumable results, logs, bundles and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace what an earlier run left."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_results(df: DataFrame, path: str, run_id: str) -> None:
    """Add the rows of one run. Rerunning the same run replaces its part only, so a restart leaves no double rows."""
    (
        df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    )


def append_log(df: DataFrame, path: str) -> None:
    """Metric log rows, one more batch."""
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(lines: DataFrame, path: str, head: Sequence[str] = ()) -> None:
    """A text file from a two-column (order, text) frame with one row per control."""
    order, text = lines.columns[:2]
    spark = lines.sparkSession
    top = spark.createDataFrame([(f"{i:04d}", line) for i, line in enumerate(head)], "o string, t string") if head else None
    body = lines.select(F.concat(F.lit("~"), F.col(order)).alias("o"), F.col(text).alias("t"))
    both = body if top is None else top.unionByName(body)
    both.orderBy("o").select("t").coalesce(1).write.mode("overwrite").text(path)
