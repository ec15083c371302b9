"""The streaming queries: the given events as a stream, against the same result over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.catalog.frames import D, rounded, table, with_decision
from equigauge.catalog.registry import registry
from equigauge.session import shared_folder
from equigauge.streaming import monitor as live
from equigauge.streaming.intake import take_in
from equigauge.streaming.live import live_monitor

QUERIES, ORACLES, registered = registry()


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in a stream; the timestamp without zone becomes one in UTC, which a watermark needs."""
    schema = table(spark, folder, "events").schema
    raw = live.read_stream(spark, folder, schema, "events.parquet")
    return with_decision(raw.withColumn("ts", F.col("ts").cast("timestamp")))


@registered("SELECT event_type AS grp, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per group, updated with each batch; the last state of each group."""
    counts = live.running_counts(_events(spark, folder), "grp")
    path = shared_folder(spark, "counts")
    live.run_to_table(counts, path, "update").awaitTermination()
    return live.latest(live.landed(spark, path, counts.schema), ["grp"])


def _in_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same stream from six files of five days each, one per batch in the order of time."""
    events = table(spark, folder, "events")
    path = shared_folder(spark, "event-files")
    for k in range(6):
        part = events.filter(F.floor((F.dayofmonth("ts") - 1) / 5) == k)
        part.coalesce(1).write.parquet(f"{path}/part{k}")
    raw = live.read_stream(spark, f"{path}/part*", events.schema)
    return with_decision(raw.withColumn("ts", F.col("ts").cast("timestamp")))


_WINDOWS = f"""{D}, k AS (SELECT time_bucket(INTERVAL '1 day', ts) AS ws, grp, count(*) AS n,
  count(*) FILTER (target = 1 AND prediction = 1) AS tp, count(*) FILTER (target = 0 AND prediction = 1) AS fp,
  count(*) FILTER (target = 0 AND prediction = 0) AS tn, count(*) FILTER (target = 1 AND prediction = 0) AS fn FROM d GROUP BY 1, 2),
f AS (SELECT *, ws + INTERVAL '1 day' > (SELECT max(ts) FROM d) - INTERVAL '1 hour' AS open FROM k)"""


@registered(f"""WITH {_WINDOWS} SELECT epoch_us(ws) AS window_start, grp, n, tp, fp, tn, fn, open FROM f""")
def stream_monitor(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion counts of all daily windows; the last ones can still change."""
    rows = live_monitor(_events(spark, folder), shared_folder(spark, "monitor"), "ts", "grp", "target", "prediction").counts
    return rows.select(F.unix_micros("window_start").alias("window_start"), "grp", "n", "tp", "fp", "tn", "fn", "open")


@registered(f"""WITH {_WINDOWS}, r AS (SELECT ws, (tp + fp) / n AS sel, coalesce(tp / nullif(tp + fn, 0), 0.0) AS tpr, coalesce(fp / nullif(fp + tn, 0), 0.0) AS fpr FROM f),
g AS (SELECT ws, max(sel) - min(sel) AS demographic_parity_diff, greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS equalized_odds_ratio FROM r GROUP BY ws),
u AS (SELECT ws, metric_key, value FROM g UNPIVOT (value FOR metric_key IN (demographic_parity_diff, equalized_odds_ratio))),
b AS (SELECT dayofmonth(ts) AS d, (dayofmonth(ts) - 1) // 5 AS batch, max(max(ts)) OVER (PARTITION BY (dayofmonth(ts) - 1) // 5) AS newest FROM d GROUP BY dayofmonth(ts))
SELECT epoch_us(ws) AS window_start, metric_key, round(value, 6) AS value, CASE metric_key WHEN 'equalized_odds_ratio' THEN 0.23 ELSE 0.12 END::DOUBLE AS threshold,
  CAST(batch AS BIGINT) AS batch, ws + INTERVAL '1 day' > newest - INTERVAL '1 hour' AS open FROM u JOIN b ON b.d = dayofmonth(ws)
WHERE NOT (value < CASE metric_key WHEN 'equalized_odds_ratio' THEN 0.23 ELSE 0.12 END)""")
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Each window and gap that passes its limit, in the batch that first showed it, from six files."""
    limits = [("demographic_parity_diff", "<", 0.12), ("equalized_odds_ratio", "<", 0.23)]
    run = live_monitor(_in_files(spark, folder), shared_folder(spark, "alerts"), "ts", "grp", "target", "prediction", limits=limits)
    return rounded(run.alerts.select(F.unix_micros("window_start").alias("window_start"), "metric_key", "value", "threshold", "batch", "open"))


@registered(f"""WITH {D}, k AS (SELECT epoch_us(time_bucket(INTERVAL '6 hours', ts)) - o * 21600000000 AS ws, grp, count(*) AS n
  FROM d, (SELECT unnest([0, 1, 2, 3]) AS o) GROUP BY 1, 2)
SELECT ws AS window_start, grp, n, ws + 86400000000 > (SELECT epoch_us(max(ts)) FROM d) - 3600000000 AS open FROM k""")
def stream_sliding(spark: SparkSession, folder: str) -> DataFrame:
    """Sliding windows of a day, moved by six hours."""
    rows = live_monitor(
        _events(spark, folder), shared_folder(spark, "sliding"), "ts", "grp", "target", "prediction",
        live.Windowing("1 day", "6 hours"),
    ).counts
    return rows.select(F.unix_micros("window_start").alias("window_start"), "grp", "n", "open")


@registered(f"""WITH {D}, e AS (SELECT dayofmonth(ts) AS epoch, count(*) AS n, round(avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM d GROUP BY 1)
SELECT epoch, n, accuracy, (SELECT min((dayofmonth(ts) - 1) // 5) FROM d WHERE dayofmonth(ts) >= epoch + 2) AS batch, epoch + 2 > (SELECT max(epoch) FROM e) AS open FROM e""")
def stream_epochs(spark: SparkSession, folder: str) -> DataFrame:
    """Outputs of six files audited epoch by epoch, the day of the month, each in the batch in which it closes."""
    stream = _in_files(spark, folder).select(F.dayofmonth("ts").alias("epoch"), "grp", "target", "prediction")

    def audit(stored: DataFrame) -> DataFrame:
        right = (F.col("target") == F.col("prediction")).cast("double")
        return stored.groupBy("epoch").agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))

    return rounded(live.epoch_audit(stream, shared_folder(spark, "epoch-results"), "epoch", audit))


@registered("""WITH l AS (SELECT event_id, event_type, CASE WHEN event_id % 97 = 0 THEN 'unreadable' WHEN event_id % 89 = 0 THEN 'unreadable' WHEN event_id % 83 = 0 THEN 'no event_type' END AS reason FROM events)
SELECT CASE WHEN reason IS NULL THEN 'row' ELSE 'reject' END AS kind, coalesce(reason, event_type) AS name, count(*) AS n, CAST(count(DISTINCT event_id % 3) AS BIGINT) AS n_files FROM l GROUP BY 1, 2""")
def stream_intake(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON lines in files, some broken, some of a wrong type, some without a column: all are found again."""
    events = table(spark, folder, "events")
    i = F.col("event_id")
    fields = F.struct("event_id", F.when(i % 83 != 0, F.col("event_type")).alias("event_type"), "value")
    wrong = F.concat(F.lit('{"event_id": "x'), i, F.lit('", "event_type": "click"}'))
    line = F.when(i % 97 == 0, F.concat(F.lit('{"event_id": '), i)).when(i % 89 == 0, wrong).otherwise(F.to_json(fields))
    path = shared_folder(spark, "lines")
    events.select(line.alias("value"), (i % 3).alias("file")).repartition("file").write.partitionBy("file").text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    taken = take_in(spark, path, schema, shared_folder(spark, "intake"), ["event_id", "event_type"])
    both = taken.rows.select(F.lit("row").alias("kind"), F.col("event_type").alias("name"), "file").union(
        taken.rejects.select(F.lit("reject"), "reason", "file"))
    return both.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("n_files"))
