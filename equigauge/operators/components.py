"""Counts from which the fairness and performance metrics follow.

A *lens* names the columns that play target, prediction and dimension. Whatever the number of lenses, the source is
read once: every row is laid under all lenses, and one aggregate counts, so each lens has only its own groups and labels
to combine before the shuffle. The result has one row per lens, group and class label, with

* `n_true`: rows whose target is the label,
* `n_pred`: rows whose prediction is the label,
* `n_hit`: rows where both are,
* `n_group`: rows of the whole group, and `leads`, which is 1 on one row of each group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigauge.functions.clean import group_key, label_text
from equigauge.functions.ratios import harmonic, ratio


@dataclass(frozen=True)
class Lens:
    """`dimension` may name several columns for an intersectional group; without one all rows form one group."""

    name: str
    target: str
    prediction: str | None = None
    dimension: tuple[str, ...] = ()
    positive: str = "1"

    @property
    def columns(self) -> tuple[str, ...]:
        bound = (self.target, *([self.prediction] if self.prediction else []), *self.dimension)
        return tuple(dict.fromkeys(bound))


def class_counts(df: DataFrame, lenses: Sequence[Lens], weight: str | None = None) -> DataFrame:
    """One row per lens, group and label. `weight` sums a count column instead of counting rows.

    Rows with an unknown target, prediction or dimension of a lens do not count for that lens.
    """
    needed = list(dict.fromkeys(c for lens in lenses for c in lens.columns))
    types = dict(df.select(*needed).dtypes)
    one = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    weighed = df.select(*needed, one.alias("_n"))

    entries: list[Column] = []
    for lens in lenses:
        y = label_text(lens.target, types[lens.target])
        grp = group_key(*[label_text(d, types[d]) for d in lens.dimension]) if lens.dimension else F.lit("")
        zero = F.lit(0).cast("bigint")
        if lens.prediction is None:
            entries.append(_entry(lens, grp, y, F.col("_n"), zero, zero, y.isNotNull()))
            continue
        p = label_text(lens.prediction, types[lens.prediction])
        known = y.isNotNull() & p.isNotNull()
        entries.append(_entry(lens, grp, y, F.col("_n"), zero, F.when(y == p, F.col("_n")).otherwise(zero), known))
        entries.append(_entry(lens, grp, p, zero, F.col("_n"), zero, known))

    if len(lenses) == 1:
        # Equal rows under the one lens are counted before each is laid under its labels.
        weighed = weighed.groupBy(*needed).agg(F.sum("_n").alias("_n"))
    laid = weighed.select(F.inline(F.array(*entries)))
    counts = (
        laid.filter(F.col("grp").isNotNull() & F.col("label").isNotNull())
        .groupBy("lens", "positive", "has_prediction", "grp", "label")
        .agg(F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred"), F.sum("n_hit").alias("n_hit"))
    )
    group = Window.partitionBy("lens", "grp")
    return counts.select(
        "*",
        F.sum("n_true").over(group).alias("n_group"),
        (F.row_number().over(group.orderBy("label")) == 1).cast("int").alias("leads"),
    )


def _entry(lens: Lens, grp: Column, label: Column, n_true: Column, n_pred: Column, n_hit: Column, ok: Column) -> Column:
    return F.struct(
        F.lit(lens.name).alias("lens"),
        F.lit(lens.positive).alias("positive"),
        F.lit(lens.prediction is not None).alias("has_prediction"),
        grp.alias("grp"),
        F.when(ok, label).alias("label"),
        n_true.cast("bigint").alias("n_true"),
        n_pred.cast("bigint").alias("n_pred"),
        n_hit.cast("bigint").alias("n_hit"),
    )


def group_rates(counts: DataFrame) -> DataFrame:
    """Confusion counts of the positive label and the rates that follow, per lens and group.

    Empty denominators give 0. Without a prediction, `selection` is the share of positive targets.
    """
    is_pos = F.col("label") == F.col("positive")
    sums = counts.groupBy("lens", "has_prediction", "grp").agg(
        F.max("n_group").alias("n"),
        F.sum("n_hit").alias("hits"),
        F.sum(F.when(is_pos, F.col("n_hit")).otherwise(0)).alias("tp"),
        F.sum(F.when(is_pos, F.col("n_true")).otherwise(0)).alias("n_positive"),
        F.sum(F.when(is_pos, F.col("n_pred")).otherwise(0)).alias("n_selected"),
    )
    cells = sums.select(
        "lens", "has_prediction", "grp", "n", "hits", "tp", "n_positive", "n_selected",
        (F.col("n_selected") - F.col("tp")).alias("fp"),
        (F.col("n_positive") - F.col("tp")).alias("fn"),
        (F.col("n") - F.col("n_selected") - F.col("n_positive") + F.col("tp")).alias("tn"),
    )
    chosen = F.when(F.col("has_prediction"), F.col("n_selected")).otherwise(F.col("n_positive"))
    return cells.select(
        "*",
        ratio("tp", F.col("tp") + F.col("fn"), 0.0).alias("tpr"),
        ratio("fp", F.col("fp") + F.col("tn"), 0.0).alias("fpr"),
        ratio("tn", F.col("tn") + F.col("fp"), 0.0).alias("tnr"),
        ratio("tp", F.col("tp") + F.col("fp"), 0.0).alias("precision"),
        ratio(chosen, "n").alias("selection"),
        ratio("n_positive", "n", 0.0).alias("positive_rate"),
    )


def class_gaps(counts: DataFrame) -> DataFrame:
    """Per lens and class: totals, and the spread over groups of prediction share and precision.

    A group without any prediction of the class has share 0 there and no precision. Groups in which the class does
    not occur at all are known from the number of groups, so no grid of groups and classes is built.
    """
    share = ratio("n_pred", "n_group")
    precision = ratio("n_hit", "n_pred")
    spread = counts.groupBy("lens", "label").agg(
        F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred"), F.sum("n_hit").alias("n_hit"),
        F.count(F.lit(1)).alias("groups_with_class"), F.sum("leads").alias("leads"),
        F.max(share).alias("share_max"), F.min(share).alias("share_min_seen"),
        F.max(precision).alias("precision_max"), F.min(precision).alias("precision_min"),
    )
    n_groups = F.sum("leads").over(Window.partitionBy("lens"))
    lowest = F.when(F.col("groups_with_class") < n_groups, 0.0).otherwise(F.col("share_min_seen"))
    recall, prec = ratio("n_hit", "n_true", 0.0), ratio("n_hit", "n_pred", 0.0)
    return spread.select(
        "lens", "label", "n_true", "n_pred", "n_hit",
        (F.col("share_max") - lowest).alias("share_gap"),
        (F.col("precision_max") - F.col("precision_min")).alias("precision_gap"),
        recall.alias("recall"), prec.alias("precision"), harmonic(prec, recall).alias("f1"),
    )


def lens_components(counts: DataFrame) -> DataFrame:
    """One wide row per lens; every registered metric is an expression over its columns."""
    rates = group_rates(counts)
    by_group = rates.groupBy("lens").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.max("n").alias("largest_group"), F.min("n").alias("smallest_group"),
        *[F.sum(c).cast("double").alias(c) for c in ("n", "hits", "tp", "fp", "tn", "fn")],
        *[
            f(c).alias(f"{c}_{name}")
            for c in ("selection", "tpr", "fpr", "tnr", "precision", "positive_rate")
            for name, f in (("max", F.max), ("min", F.min))
        ],
    )
    seen = F.when(F.col("n_true") > 0, F.col("n_true"))
    by_class = class_gaps(counts).groupBy("lens").agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min(seen).alias("smallest_class"), F.max(seen).alias("largest_class"),
        F.count(seen).alias("n_target_classes"),
        F.max(F.col("label").try_cast("double")).alias("largest_label"),
        F.max("share_gap").alias("share_gap_max"), F.avg("share_gap").alias("share_gap_mean"),
        F.max("precision_gap").alias("precision_gap_max"), F.avg("precision_gap").alias("precision_gap_mean"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
    )
    return by_group.join(by_class, "lens")


def group_confusion(df: DataFrame, dimension: str, target: str, prediction: str, positive: object = 1) -> DataFrame:
    """Confusion counts and TPR, FPR, TNR per group in one aggregation; 0 on an empty denominator."""
    y, p = F.col(target) == F.lit(positive), F.col(prediction) == F.lit(positive)
    known = df.filter(F.col(dimension).isNotNull() & F.col(target).isNotNull() & F.col(prediction).isNotNull())
    cells = known.groupBy(F.col(dimension).alias("grp")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"),
    )
    return cells.select(
        "*",
        ratio("tp", F.col("tp") + F.col("fn"), 0.0).alias("tpr"),
        ratio("fp", F.col("fp") + F.col("tn"), 0.0).alias("fpr"),
        ratio("tn", F.col("tn") + F.col("fp"), 0.0).alias("tnr"),
    )


def confusion_long(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """Confusion matrix as (target, prediction, n)."""
    return (
        df.filter(F.col(target).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(target).alias("target"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_wide(df: DataFrame, target: str, prediction: str, labels: Sequence[object]) -> DataFrame:
    """Confusion matrix with one column per label of a given list."""
    counted = confusion_long(df, target, prediction)
    return counted.groupBy("target").pivot("prediction", list(labels)).agg(F.sum("n")).na.fill(0)


def class_recall(df: DataFrame, target: str, prediction: str, labels: Sequence[object]) -> DataFrame:
    """Share of right predictions per class of a given list, 0 for a class without rows."""
    spark = df.sparkSession
    kind = df.schema[target].dataType.simpleString()
    grid = spark.createDataFrame([(x,) for x in labels], f"label {kind}")
    counted = df.filter(F.col(target).isNotNull() & F.col(prediction).isNotNull()).groupBy(
        F.col(target).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == F.col(prediction)).alias("hits"))
    return grid.join(counted, "label", "left").select(
        "label",
        F.coalesce("n", F.lit(0)).alias("n"),
        ratio("hits", "n", 0.0).alias("recall"),
    )
