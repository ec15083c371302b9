"""Cohort robustness: how a score holds up across scanners, ages, lesion types and volumes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.functions.bins import cut
from equigauge.functions.ratios import pearson, relative_drop
from equigauge.operators.quantiles import quantile_of
from equigauge.session import settle

# Age bands of the cohort checks.
AGE_EDGES = (0, 50, 70, 100)
AGE_NAMES = ("<50", "50-70", ">70")


def group_floor(df: DataFrame, group: str, value: str, more_than: int = 5) -> DataFrame:
    """Lowest group mean among groups with more than `more_than` rows, at most 1."""
    means = df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    return means.filter(F.col("n") > more_than).agg(
        F.least(F.lit(1.0), F.coalesce(F.min("mean"), F.lit(1.0))).alias("floor"), F.count(F.lit(1)).alias("n_groups")
    )


def large_groups(df: DataFrame, group: str, more_than: int) -> DataFrame:
    """Rows of the groups that have more than `more_than` rows."""
    kept = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than).select(group)
    return df.join(kept, group, "left_semi")


def top_groups(df: DataFrame, group: str, value: str, k: int = 3) -> DataFrame:
    """The k most frequent groups with their mean; ties go to the lesser name."""
    return (
        df.filter(F.col(group).isNotNull()).groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
        .orderBy(F.desc("n"), F.asc(group)).limit(k)
    )


def top_floor(df: DataFrame, group: str, value: str, k: int = 3) -> DataFrame:
    """Lowest mean among the k most frequent groups, at most 1."""
    return top_groups(df, group, value, k).agg(F.least(F.lit(1.0), F.coalesce(F.min("mean"), F.lit(1.0))).alias("floor"))


def _flag_rows(df: DataFrame, flags: Sequence[str], value: str) -> DataFrame:
    """One row per set flag; a row with several flags counts in each of those subsets."""
    entries = [F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("flag"), F.col(value).alias("v"))) for f in flags]
    return df.select(F.inline(F.array_compact(F.array(*entries))))


def flag_means(df: DataFrame, flags: Sequence[str], value: str) -> DataFrame:
    """Mean of the value over the rows in which each flag column is filled."""
    return _flag_rows(df, flags, value).groupBy("flag").agg(F.avg("v").alias("mean"), F.count(F.lit(1)).alias("n"))


def flag_floor(df: DataFrame, flags: Sequence[str], value: str, more_than: int = 3) -> DataFrame:
    """Lowest of those means among flags with more than `more_than` rows, at most 1."""
    return flag_means(df, flags, value).filter(F.col("n") > more_than).agg(
        F.least(F.lit(1.0), F.coalesce(F.min("mean"), F.lit(1.0))).alias("floor")
    )


def low_tail_mean(df: DataFrame, by: str, value: str, prob: float = 0.25) -> DataFrame:
    """Mean of `value` over rows whose `by` is strictly below its quantile."""
    edge = quantile_of(df, by, prob)
    return df.agg(F.avg(F.when(F.col(by) < edge, F.col(value))).alias("mean"))


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept of y on x."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


@dataclass(frozen=True)
class CohortColumns:
    """Where the cohort metrics find their inputs; None leaves the metric at its neutral value."""

    score: str = "Dice"
    confidence: str | None = "Confidence"
    volume: str | None = "SpineVol"
    sex: str | None = "Sex"
    male: str = "M"
    female: str = "F"
    scanner: str | None = "Manufacturer"
    age: str | None = "Age"
    diagnosis: str | None = "Primary cancer"
    lesions: tuple[str, ...] = ("Lytic", "Blastic")


def cohort_groups(df: DataFrame, names: CohortColumns = CohortColumns()) -> DataFrame:
    """Rows, mean and largest score, and correlation with the confidence per (dimension, group), in one aggregate.

    Every row is laid under the whole cohort, its sex, scanner, diagnosis, set lesion flags and the oldest age band; groups
    combine before the shuffle. Unknown groups do not count.
    """
    def under(dimension: str, group: Column, holds: Column) -> Column:
        return F.when(holds, F.struct(F.lit(dimension).alias("dimension"), group.cast("string").alias("grp")))

    none = F.lit("")
    entries = [under("all", none, F.lit(True))]
    for dimension, column in (("sex", names.sex), ("scanner", names.scanner), ("diagnosis", names.diagnosis)):
        if column:
            entries.append(under(dimension, F.col(column), F.col(column).isNotNull()))
    entries += [under("lesion", F.lit(flag), F.col(flag).isNotNull()) for flag in names.lesions]
    if names.age:
        entries.append(under("old", none, cut(names.age, AGE_EDGES, AGE_NAMES) == AGE_NAMES[-1]))
    confidence = F.col(names.confidence).cast("double") if names.confidence else F.lit(None).cast("double")
    laid = df.select(F.col(names.score).alias("score"), confidence.alias("confidence"), F.inline(F.array_compact(F.array(*entries))))
    return laid.groupBy("dimension", "grp").agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"), F.max("score").cast("double").alias("most"), pearson("confidence", "score").alias("r"))


def cohort_metrics(df: DataFrame, names: CohortColumns = CohortColumns()) -> DataFrame:
    """The cohort dictionary as one row.

    The cohort is stored as it is given, once; all groups come from one aggregate over it, and the low tail from its own.
    """
    used = [names.score, names.confidence, names.volume, names.sex, names.scanner, names.age, names.diagnosis, *names.lesions]
    rows = settle(df.select(*dict.fromkeys(c for c in used if c)))
    groups = cohort_groups(rows, names)
    of = lambda dimension: F.col("dimension") == dimension
    named = lambda dimension, grp: of(dimension) & (F.col("grp") == grp)
    neutral = F.lit(1.0)

    def floor(dimension: str, more_than: int) -> Column:
        return F.least(neutral, F.coalesce(F.min(F.when(of(dimension) & (F.col("n") > more_than), F.col("mean"))), neutral))

    common = groups.filter(of("diagnosis")).orderBy(F.desc("n"), F.asc("grp")).limit(3).agg(F.least(neutral, F.coalesce(F.min("mean"), neutral)))
    one = groups.agg(
        F.coalesce(F.try_divide(F.min(F.when(of("sex"), F.col("n"))).cast("double"), F.sum(F.when(of("sex"), F.col("n"))).cast("double")), F.lit(0.0)).alias("minority_sex_prop"),
        F.max(F.when(of("all"), F.col("mean"))).alias("global_dice"), F.max(F.when(of("all"), F.col("most"))).alias("max_single_dice"),
        F.max(F.when(named("sex", names.male), F.col("mean"))).alias("_male"), F.max(F.when(named("sex", names.female), F.col("mean"))).alias("_female"),
        floor("scanner", 5).alias("min_scanner_dice"), floor("lesion", 3).alias("min_lesion_type_dice"),
        F.max(F.when(of("old"), F.col("mean"))).alias("_old"), F.max(F.when(of("all"), F.col("r"))).alias("_r"),
    )
    return one.select(
        "minority_sex_prop", "global_dice", "max_single_dice",
        F.coalesce(F.abs(F.col("_male") - F.col("_female")), F.lit(0.0)).alias("gender_gap"), "min_scanner_dice",
        (low_tail_mean(rows, names.volume, names.score).scalar() if names.volume else neutral).alias("small_vol_dice"),
        "min_lesion_type_dice", relative_drop(F.col("global_dice"), F.col("_old")).alias("age_bias"),
        (common.scalar() if names.diagnosis else neutral).alias("min_cancer_dice"), F.col("_r").alias("confidence_correlation"),
    )


def as_metric_rows(one: DataFrame) -> DataFrame:
    """One wide row of metrics as long (metric_key, value)."""
    return one.select(*[F.col(c).cast("double").alias(c) for c in one.columns]).unpivot([], one.columns, "metric_key", "value")


def age_holds(df: DataFrame, names: CohortColumns = CohortColumns(), limit: float = 0.10) -> DataFrame:
    """Whether the drop for the oldest band stays below the limit; true when that band is empty."""
    score = F.col(names.score)
    one = df.agg(F.avg(score).alias("g"), F.avg(F.when(cut(names.age, AGE_EDGES, AGE_NAMES) == AGE_NAMES[-1], score)).alias("e"))
    return one.select(F.coalesce(F.try_divide(F.col("g") - F.col("e"), F.col("g")) < limit, F.lit(True)).alias("holds"))


def top_groups_hold(df: DataFrame, group: str, value: str, floor: float = 0.80, k: int = 3) -> DataFrame:
    """Whether none of the k most frequent groups has a mean below the floor."""
    return top_groups(df, group, value, k).agg(
        F.coalesce(F.every(F.coalesce(F.col("mean") >= floor, F.lit(True))), F.lit(True)).alias("holds")
    )
