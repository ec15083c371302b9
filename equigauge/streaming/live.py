"""Windows judged while a stream runs: counts that go on from batch to batch, alerts raised once, open windows at the end.

Each batch is counted by Spark, added to the counts of the windows that are still open, and stored under its number next
to the newest time seen; a batch that is run again replaces itself. A window is closed, and leaves the counts that are
carried on, once the newest time is past its end by the allowed delay. Only sums per window and group are ever kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.session import shared_folder
from equigauge.streaming.monitor import Windowing, alerts, window_gaps

COUNTS = ("n", "tp", "fp", "tn", "fn")
_COUNT_ROW = "window_start timestamp, window_end timestamp, grp string, " + ", ".join(f"{c} long" for c in COUNTS) + ", open boolean"
_ALERT_ROW = ("window_start timestamp, window_end timestamp, n_rows long, metric_key string, value double, operator string, "
              "threshold double, message string, open boolean")


@dataclass
class LiveRun:
    """What a monitor has stored: the final counts of closed windows and the last ones of open windows, and its alerts.

    Both have `open` and the `batch` in which they were written; an alert's `open` tells whether its window could still
    change when it was raised.
    """

    counts: DataFrame
    alerts: DataFrame


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch long").parquet(path)


def live_monitor(
    stream: DataFrame, path: str, at: str, group: str, target: str, prediction: str, windowing: Windowing = Windowing(),
    limits: Sequence[tuple[str, str, float]] = (), positive: object = 1, checkpoint: str | None = None,
) -> LiveRun:
    """Confusion counts per window and group over what is there, and an alert for every limit that a window breaks.

    `limits` are (metric, operator, threshold). An alert is raised in the first batch that shows it, also while its window
    is open, and not again. Rows of windows that are closed already are late and dropped. Started again with the same
    `path` and `checkpoint`, it goes on where it ended.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or shared_folder(spark, "stream-state")
    span = F.window(at, windowing.length, windowing.slide) if windowing.slide else F.window(at, windowing.length)
    y, p = F.col(target) == F.lit(positive), F.col(prediction) == F.lit(positive)
    known = F.col(group).isNotNull() & F.col(target).isNotNull() & F.col(prediction).isNotNull()

    def counted(batch: DataFrame) -> DataFrame:
        rows = batch.filter(F.col(at).isNotNull()).select(span.alias("w"), F.when(known, F.col(group)).alias("grp"), y.alias("y"), p.alias("p"), at)
        return rows.groupBy("w", "grp").agg(
            F.count(F.lit(1)).alias("n"), *(F.count_if(F.expr(e)).alias(c) for c, e in zip(COUNTS[1:], ("y AND p", "NOT y AND p", "NOT y AND NOT p", "y AND NOT p"))),
            F.max(at).alias("newest"),
        ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.col("grp").cast("string").alias("grp"), *COUNTS, "newest")

    def land(batch: DataFrame, number: int) -> None:
        new_path = f"{path}/new/batch={number}"
        counted(batch).write.mode("overwrite").parquet(new_path)
        new = spark.read.parquet(new_path)
        before = spark.read.parquet(f"{path}/marks/batch={number - 1}").first()["newest"] if number else None
        newest = new.agg(F.max("newest")).first()[0]
        newest = max(filter(None, (before, newest)), default=None)
        spark.createDataFrame([(newest,)], "newest timestamp").write.mode("overwrite").parquet(f"{path}/marks/batch={number}")
        limit = lambda mark: F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {windowing.delay}")
        fresh = new.filter("grp IS NOT NULL").filter(F.lit(before is None) | (F.col("window_end") > limit(before))).drop("newest")
        if number:
            fresh = fresh.unionByName(spark.read.schema(_COUNT_ROW).parquet(f"{path}/counts/batch={number - 1}").filter("open").drop("open"))
        merged = fresh.groupBy("window_start", "window_end", "grp").agg(*(F.sum(c).alias(c) for c in COUNTS))
        merged.withColumn("open", F.coalesce(F.col("window_end") > limit(newest), F.lit(True))).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")
        if limits:
            now = spark.read.schema(_COUNT_ROW).parquet(f"{path}/counts/batch={number}")
            broken = alerts(window_gaps(now), limits).join(now.select("window_start", "open").distinct(), "window_start")
            if number:
                raised = _stored(spark, f"{path}/alerts", _ALERT_ROW).filter(F.col("batch") < number).select("window_start", "metric_key", "threshold")
                broken = broken.join(raised, ["window_start", "metric_key", "threshold"], "left_anti")
            broken.select(*(c.split()[0] for c in _ALERT_ROW.split(", "))).write.mode("overwrite").parquet(f"{path}/alerts/batch={number}")

    query = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    counts = _stored(spark, f"{path}/counts", _COUNT_ROW)
    last = counts.agg(F.max("batch")).first()[0]
    raised = _stored(spark, f"{path}/alerts", _ALERT_ROW) if limits else spark.createDataFrame([], f"{_ALERT_ROW}, batch long")
    return LiveRun(counts.filter(~F.col("open") | (F.col("batch") == F.lit(last))), raised)
