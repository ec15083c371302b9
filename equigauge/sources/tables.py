"""Readers: delimited tables, file listings and stored results."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.functions.clean import finite


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema there is one pass over the files; NaN is stored as NULL either way."""
    reader = spark.read.option("header", True).option("nullValue", "").option("mode", "PERMISSIVE")
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return without_nan(df)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, so that aggregates skip it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(c) for c in floats}) if floats else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folder or file; other formats by their extension."""
    if path.endswith(".csv"):
        return read_delimited(spark, path)
    if path.endswith(".json"):
        return spark.read.json(path)
    if path.endswith(".orc"):
        return spark.read.orc(path)
    return spark.read.parquet(path)


def read_or_sample(spark: SparkSession, path: str, fallback: DataFrame, schema: T.StructType) -> DataFrame:
    """The table at the path, or the fallback table where the path does not exist; both in one schema."""
    try:
        df = read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = fallback
    return conform(df, schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order and types; unreadable values and missing columns are NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def list_files(spark: SparkSession, folder: str, pattern: str = "*.dcm", id_pattern: str = r"([^/]+)/[^/]+$") -> DataFrame:
    """Every matching file below a folder: owner id, path, size, and whether the path names a segmentation.

    Only the listing is read; file contents are pruned away.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
        .select("path", "length")
    )
    local = F.regexp_replace("path", F.lit(r"^file:/+"), F.lit("/"))
    root = re.sub(r"^file:/+", "/", folder.rstrip("/")) + "/"
    inner = F.when(local.startswith(root), F.substring(local, len(root) + 1, 2**31 - 1)).otherwise(local)
    return files.select(
        F.regexp_extract("path", id_pattern, 1).alias("owner"), "path", "length",
        F.upper(inner).contains("SEG").alias("is_segmentation"),
    )


def split_listing(files: DataFrame) -> DataFrame:
    """Scans and segmentations per owner. Long form: one row per file with its rank in path order."""
    kind = F.when(F.col("is_segmentation"), "seg").otherwise("ct")
    rank = F.row_number().over(Window.partitionBy("owner", "kind").orderBy("path"))
    return files.withColumn("kind", kind).withColumn("rank", rank).drop("is_segmentation")


_METRIC = (
    "struct<control_id: string, description: string, metric_key: string, actual_value: double, threshold: double, "
    "operator: string, passed: boolean, severity: string>"
)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Stored results in list form (`[{...}]`) or object form (`{"metrics": [{...}]}`) as flat rows."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("value"))
    as_list = F.from_json("value", f"array<{_METRIC}>")
    as_object = F.from_json("value", f"struct<metrics: array<{_METRIC}>>")["metrics"]
    items = F.when(F.col("value").startswith("["), as_list).otherwise(as_object)
    unread = F.raise_error(F.concat(F.lit("no results in: "), F.left("value", F.lit(60)))).cast(f"array<{_METRIC}>")
    return text.filter("value <> ''").select(F.inline(F.coalesce(items, unread)))
