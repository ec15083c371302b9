"""What is made of results: summaries, metric logs, report lines and comparisons of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.functions.judge import risk_band, suspicious
from equigauge.functions.ratios import ratio


def summary(results: DataFrame, *by: str) -> DataFrame:
    """Controls, passed and failed ones, percentage and overall verdict; optionally per severity, article or phase."""
    passed = F.coalesce("passed", F.lit(False))
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"),
        ratio(F.count_if(passed) * 100, F.count(F.lit(1)), 0.0).alias("percentage"),
        F.coalesce(F.every(passed), F.lit(True)).alias("overall_pass"),
    )


def metric_log(results: DataFrame, prefix: str = "") -> DataFrame:
    """Flat (key, value) pairs such as `post_training.governance.<id>.pass`, and the overall verdict."""
    head = f"{prefix}." if prefix else ""
    entries = F.array(
        F.struct(F.concat(F.lit(f"{head}governance."), "control_id", F.lit(".pass")).alias("key"),
                 F.col("passed").cast("int").cast("double").alias("value")),
        F.struct(F.concat(F.lit(f"{head}governance."), "control_id", F.lit(".value")).alias("key"),
                 F.col("actual_value").alias("value")),
        F.struct(F.concat(F.lit(f"{head}governance."), "control_id", F.lit(".threshold")).alias("key"),
                 F.col("threshold").alias("value")),
        F.struct(F.concat(F.lit(f"{head}metrics."), "metric_key").alias("key"), F.col("actual_value").alias("value")),
    )
    overall = summary(results).select(
        F.lit("governance.overall_pass").alias("key"), F.col("overall_pass").cast("int").cast("double").alias("value")
    )
    return results.select(F.inline(entries)).unionByName(overall)


def report_rows(results: DataFrame) -> DataFrame:
    """One Markdown table line per control."""
    icon = F.when(F.col("passed"), "✅").otherwise("❌")
    value = F.coalesce(F.format_string("%.3f", "actual_value"), F.lit("N/A"))
    limit = F.col("threshold").cast("string")
    line = F.concat_ws(" | ", F.concat(F.lit("| "), "control_id"), icon, value, F.concat(limit, F.lit(" |")))
    return results.select("requirement_id", line.alias("line"))


def report_sections(results: DataFrame) -> DataFrame:
    """One Markdown section per control."""
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("### "), F.when(F.col("passed"), "✅").otherwise("❌"), F.lit(" "), "control_id"),
        F.concat(F.lit("- **Description**: "), F.coalesce("description", F.lit(""))),
        F.concat(F.lit("- **Severity**: "), F.coalesce("severity", F.lit("Unknown"))),
        F.concat(F.lit("- **Article**: "), F.coalesce("article", F.lit("Unknown"))),
        F.concat(F.lit("- **Result**: "), "message"),
    )
    return results.select("requirement_id", text.alias("section"))


def findings(results: DataFrame) -> DataFrame:
    """Results with their risk band and marks for perfect or missing values."""
    return results.withColumns({
        "risk": risk_band(F.col("metric_key"), F.col("actual_value")),
        "suspicious": suspicious(F.col("actual_value")),
        "missing_value": F.col("actual_value").isNull(),
    })


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two runs side by side per policy and requirement, with the change of the value."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "policy_id", "requirement_id", "metric_key",
            F.col("actual_value").alias(f"{name}_value"), F.col("passed").alias(f"{name}_passed"),
        )

    joined = side(before, "before").join(side(after, "after"), ["policy_id", "requirement_id", "metric_key"], "full_outer")
    return joined.withColumn("delta", F.col("after_value") - F.col("before_value"))


def bundle(pre: DataFrame, post: DataFrame, **training: object) -> DataFrame:
    """Pre and post results with run details as one nested row. Result tables have one row per control."""
    fields = ["control_id", "metric_key", "actual_value", "threshold", "operator", "passed", "severity"]

    def nested(df: DataFrame) -> DataFrame:
        return df.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("m"))

    details = F.struct(*[F.lit(v).alias(k) for k, v in training.items()], F.current_timestamp().alias("timestamp"))
    return nested(pre).select(
        F.col("m").alias("pre_metrics"), nested(post).scalar().alias("post_metrics"), details.alias("training_metadata")
    )
