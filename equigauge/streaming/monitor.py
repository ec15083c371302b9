"""Decisions audited while they arrive.

Only counts that add up are kept per window and group, so state grows with windows times groups, not with rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from equigauge.functions.judge import compare, message
from equigauge.functions.ratios import ratio
from equigauge.session import shared_folder

RATE_KEYS = ("demographic_parity_diff", "equal_opportunity_diff", "predictive_equality_diff", "equalized_odds_ratio")


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None, files_per_batch: int = 1
) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number of files per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def running_counts(stream: DataFrame, column: str) -> DataFrame:
    """Records per value so far; records without a value are skipped. For update or complete mode."""
    return stream.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Windowing:
    """Tumbling windows, or sliding ones with a `slide`. Rows later than `delay` behind the newest are dropped."""

    length: str = "1 day"
    slide: str | None = None
    delay: str = "1 hour"


def windowed_confusion(
    stream: DataFrame, at: str, group: str, target: str, prediction: str, windowing: Windowing = Windowing(),
    positive: object = 1,
) -> DataFrame:
    """Confusion counts per window and group, emitted once a window can no longer change."""
    y, p = F.col(target) == F.lit(positive), F.col(prediction) == F.lit(positive)
    if windowing.slide:
        span = F.window(at, windowing.length, windowing.slide)
    else:
        span = F.window(at, windowing.length)
    return (
        stream.withWatermark(at, windowing.delay)
        .filter(F.col(group).isNotNull() & F.col(target).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(span.alias("w"), F.col(group).alias("grp"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "grp", "n", "tp", "fp", "tn", "fn")
    )


def window_gaps(counts: DataFrame) -> DataFrame:
    """Fairness gaps per window from its group counts; one row per window and metric."""
    rates = counts.select(
        "window_start", "window_end", "n",
        ratio(F.col("tp") + F.col("fp"), "n").alias("sel"),
        ratio("tp", F.col("tp") + F.col("fn"), 0.0).alias("tpr"), ratio("fp", F.col("fp") + F.col("tn"), 0.0).alias("fpr"),
    )
    wide = rates.groupBy("window_start", "window_end").agg(
        F.sum("n").alias("n_rows"),
        (F.max("sel") - F.min("sel")).alias("demographic_parity_diff"),
        (F.max("tpr") - F.min("tpr")).alias("equal_opportunity_diff"),
        (F.max("fpr") - F.min("fpr")).alias("predictive_equality_diff"),
    ).withColumn("equalized_odds_ratio", F.greatest("equal_opportunity_diff", "predictive_equality_diff"))
    return wide.unpivot(["window_start", "window_end", "n_rows"], list(RATE_KEYS), "metric_key", "value")


def alerts(gaps: DataFrame, limits: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Windows that break a limit given as (metric, operator, threshold)."""
    table = gaps.sparkSession.createDataFrame(list(limits), "metric_key string, operator string, threshold double")
    # As many rows as there are limits in the call.
    judged = gaps.join(F.broadcast(table), "metric_key")
    holds = compare(F.col("value"), F.col("operator"), F.col("threshold"))
    return judged.filter(~F.coalesce(holds, F.lit(False))).withColumn(
        "message", message(F.col("value"), F.col("operator"), F.col("threshold"))
    )


def run_to_table(
    stream: DataFrame, path: str, mode: str = "append", each: Callable[[DataFrame], DataFrame] | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Process what is there and stop. Batches land under their own number, so a retried batch replaces itself."""
    spark = stream.sparkSession
    checkpoint = checkpoint or shared_folder(spark, "stream-state")

    def land(batch: DataFrame, number: int) -> None:
        out = each(batch) if each else batch
        out.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.outputMode(mode).foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Everything the batches of a query wrote, with the batch number."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(with_batch).parquet(path)


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For update-mode output: the last state of each key."""
    newest = F.max_by(F.struct(*[c for c in rows.columns if c not in (*keys, "batch")]), "batch").alias("s")
    return rows.groupBy(*keys).agg(newest).select(*keys, "s.*")


def monitor(
    stream: DataFrame, path: str, at: str, group: str, target: str, prediction: str,
    windowing: Windowing = Windowing(), positive: object = 1,
) -> DataFrame:
    """Run the monitor over the available data; returns the stored window counts."""
    counts = windowed_confusion(stream, at, group, target, prediction, windowing, positive)
    run_to_table(counts, path).awaitTermination()
    return landed(stream.sparkSession, path, counts.schema)


def epoch_audit(
    stream: DataFrame, path: str, epoch: str, audit: Callable[[DataFrame], DataFrame], staging: str | None = None, behind: int = 1,
) -> DataFrame:
    """Audit every epoch once, as soon as it closes: what `audit` gives for its rows, with `batch` and `open`.

    Epochs are numbers that rise in the stream. One is closed when an epoch more than `behind` later has come; its rows are
    audited in that batch and rows that come later are left out. Epochs still open when the stream has ended are audited
    then, with `open` true and no batch. Rows are appended to a table partitioned by epoch, so nothing piles up on the
    driver, which knows the newest epoch alone. A batch that is run again replaces itself.
    """
    spark = stream.sparkSession
    staging = staging or shared_folder(spark, "epochs")
    fields = T.StructType([f for f in stream.schema.fields if f.name != epoch] + [stream.schema[epoch]])
    with_batch = T.StructType([*fields.fields, T.StructField("batch", T.LongType())])
    number_of = F.col(epoch).cast("long")

    def closed_until(number: int) -> int | None:
        """The newest epoch that was closed up to this batch."""
        return spark.read.parquet(f"{staging}-marks/batch={number}").first()["closed"] if number >= 0 else None

    def land(batch: DataFrame, number: int) -> None:
        before = closed_until(number - 1)
        in_time = batch.filter(number_of.isNotNull() & (F.lit(before is None) | (number_of > F.lit(before))))
        (
            in_time.withColumn("batch", F.lit(number)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(epoch, "batch").parquet(staging)
        )
        newest = batch.agg(F.max(number_of)).first()[0]
        closed = before if newest is None else max(x for x in (before, newest - behind - 1) if x is not None)
        spark.createDataFrame([(closed,)], "closed long").write.mode("overwrite").parquet(f"{staging}-marks/batch={number}")
        if closed is not None and closed != before:
            stored = spark.read.schema(with_batch).parquet(staging).filter(F.col("batch") <= number)
            due = stored.filter((number_of <= closed) & (F.lit(before is None) | (number_of > F.lit(before))))
            if not due.isEmpty():
                audit(due).withColumn("open", F.lit(False)).write.mode("overwrite").parquet(f"{path}/audit={number}")

    query = (
        stream.writeStream.foreachBatch(land).option("checkpointLocation", shared_folder(spark, "stream-state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    marks = spark.read.schema("closed long, batch long").parquet(f"{staging}-marks")
    closed = marks.agg(F.max("closed")).first()[0]
    rest = spark.read.schema(with_batch).parquet(staging).filter(F.lit(closed is None) | (number_of > F.lit(closed)))
    audit(rest).withColumn("open", F.lit(True)).write.mode("overwrite").parquet(f"{path}/audit=-1")
    told = spark.read.parquet(path)
    return told.withColumn("batch", F.when(F.col("audit") >= 0, F.col("audit")).cast("long")).drop("audit")
