"""Taking in lines of which some cannot be read: those are set aside with file and reason, the others are counted on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.session import shared_folder

_CORRUPT = "_unreadable"


@dataclass
class Intake:
    """Rows that were read, and lines that were not: file, line, reason; both with the batch."""

    rows: DataFrame
    rejects: DataFrame


def _reason(schema: T.StructType, required: list[str]) -> Column:
    reason = F.when(F.col(f"parsed.{_CORRUPT}").isNotNull(), "unreadable")
    for name in required:
        reason = reason.when(F.col(f"parsed.`{name}`").isNull(), f"no {name}")
    return reason


def take_in(spark: SparkSession, folder: str, schema: T.StructType, path: str, required: list[str] | None = None,
            pattern: str | None = None, files_per_batch: int = 1, checkpoint: str | None = None) -> Intake:
    """Read the JSON lines of a folder as a stream and store them in two tables under `path`.

    A line that is no JSON object, or holds a value that its column's type cannot take, is unreadable; one that lacks a
    `required` column is named so. Blank lines count as nothing. Nothing else is lost: rows and rejects add up to the
    lines. A batch that is run again replaces itself.
    """
    checkpoint = checkpoint or shared_folder(spark, "stream-state")
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    lines = (reader.option("pathGlobFilter", pattern) if pattern else reader).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])

    def land(batch: DataFrame, number: int) -> None:
        parsed = batch.filter(F.trim("line") != "").select("file", "line", F.from_json("line", with_corrupt, {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("parsed"))
        told = parsed.withColumn("reason", F.coalesce(_reason(schema, required or []), F.when(F.col("parsed").isNull(), "unreadable")))
        place = f"{path}/lines/batch={number}"
        # One pass over the lines; readers take one side of it each.
        told.withColumn("readable", F.col("reason").isNull()).write.mode("overwrite").partitionBy("readable").parquet(place)

    query = lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    stored = spark.read.schema(T.StructType([
        T.StructField("file", T.StringType()), T.StructField("line", T.StringType()), T.StructField("parsed", with_corrupt),
        T.StructField("reason", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("readable", T.BooleanType())])).parquet(f"{path}/lines")
    rows = stored.filter("readable").select("file", "batch", *(F.col(f"parsed.`{f.name}`").alias(f.name) for f in schema.fields))
    return Intake(rows, stored.filter("NOT readable").select("file", "batch", "line", "reason"))
