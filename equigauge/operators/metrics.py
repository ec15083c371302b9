"""Registry of metrics. A metric is an expression over the wide row of `lens_components`."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.functions.ratios import harmonic, ratio
from equigauge.operators.components import Lens, class_counts, lens_components


@dataclass(frozen=True)
class Metric:
    """`scope` says which lens feeds the metric: `groups` needs a dimension, `rows` takes all rows as one group."""

    key: str
    expr: Callable[[], Column]
    scope: str
    category: str
    ideal: float | None = None
    description: str = ""
    reference: str = ""
    variants: dict[str, Callable[[], Column]] = field(default_factory=dict)
    needs_prediction: bool = True


METRICS: dict[str, Metric] = {}
ALIASES: dict[str, str] = {"disparate_impact_ratio": "disparate_impact"}


def register_metric(metric: Metric) -> Metric:
    """Add or replace a metric; users extend the audit with their own expressions this way."""
    METRICS[metric.key] = metric
    return metric


def find_metric(key: str) -> Metric | None:
    return METRICS.get(ALIASES.get(key, key))


def metric_catalogue(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    """The registry as a table, optionally only keys that match a pattern."""
    rows = [(m.key, m.category, m.scope, m.ideal, m.description, m.reference) for m in METRICS.values()]
    df = spark.createDataFrame(
        rows, "metric_key string, category string, scope string, ideal double, description string, reference string"
    )
    return df if pattern is None else df.filter(F.col("metric_key").rlike(pattern))


def _spread(name: str) -> Column:
    return F.col(f"{name}_max") - F.col(f"{name}_min")


def _binary_precision() -> Column:
    return ratio("tp", F.col("tp") + F.col("fp"), 0.0)


def _binary_recall() -> Column:
    return ratio("tp", F.col("tp") + F.col("fn"), 0.0)


def _add(key: str, expr: Callable[[], Column], scope: str, category: str, ideal: float | None, text: str, **more) -> None:
    register_metric(Metric(key, expr, scope, category, ideal, text, **more))


def _by_classes(binary: Callable[[], Column], multi: str) -> Callable[[], Column]:
    """The binary form for up to two classes, otherwise the form over all classes."""
    return lambda: F.when(F.col("n_classes") > 2, F.col(multi)).otherwise(binary())


def _binary_f1() -> Column:
    return harmonic(_binary_precision(), _binary_recall())


_add("accuracy_score", lambda: ratio("hits", "n"), "rows", "performance", 1.0, "share of right predictions")
_add("precision_score", _by_classes(_binary_precision, "precision_macro"), "rows", "performance", 1.0, "TP / (TP + FP)",
     variants={"macro": lambda: F.col("precision_macro"), "binary": _binary_precision})
_add("recall_score", _by_classes(_binary_recall, "recall_macro"), "rows", "performance", 1.0, "TP / (TP + FN)",
     variants={"macro": lambda: F.col("recall_macro"), "binary": _binary_recall})
_add("f1_score", _by_classes(_binary_f1, "f1_macro"), "rows", "performance", 1.0,
     "harmonic mean of precision and recall", variants={"macro": lambda: F.col("f1_macro"), "binary": _binary_f1})

_add("demographic_parity_diff", lambda: _spread("selection"), "groups", "fairness", 0.0,
     "largest minus smallest selection rate", reference="Dwork et al. 2012", needs_prediction=False)
_add("disparate_impact", lambda: ratio("selection_min", "selection_max"), "groups", "fairness", 1.0,
     "smallest over largest selection rate", needs_prediction=False)
_add("equal_opportunity_diff", lambda: _spread("tpr"), "groups", "fairness", 0.0,
     "spread of true positive rates", reference="Hardt et al. 2016")
_add("predictive_equality_diff", lambda: _spread("fpr"), "groups", "fairness", 0.0,
     "spread of false positive rates", reference="Corbett-Davies et al. 2017")
_add("equalized_odds_ratio", lambda: F.greatest(_spread("tpr"), _spread("fpr")), "groups", "fairness", 0.0,
     "larger of the TPR and FPR spreads", reference="Hardt et al. 2016")
_add("true_negative_rate_diff", lambda: _spread("tnr"), "groups", "fairness", 0.0, "spread of true negative rates")
_add("predictive_parity", _by_classes(lambda: _spread("precision"), "precision_gap_max"), "groups", "fairness", 0.0,
     "spread of precision over groups", reference="Corbett-Davies et al. 2017",
     variants={"max": lambda: F.col("precision_gap_max"), "macro": lambda: F.col("precision_gap_max"),
               "mean": lambda: F.col("precision_gap_mean")})
_add("multiclass_demographic_parity", lambda: F.col("share_gap_max"), "groups", "fairness", 0.0,
     "spread over groups of a class's prediction share",
     variants={"max": lambda: F.col("share_gap_max"), "macro": lambda: F.col("share_gap_mean"),
               "mean": lambda: F.col("share_gap_mean")})

_add("class_imbalance", lambda: ratio("smallest_class", "largest_class"), "rows", "quality", 1.0,
     "rarest over commonest class", needs_prediction=False)
_add("minority_share", lambda: ratio("smallest_class", "n"), "rows", "quality", None,
     "share of the rarest class", needs_prediction=False)


def metric_value(metric: Metric, variant: str | None = None) -> Column:
    """The expression of a metric, in one of its variants if it has that one."""
    return metric.variants.get(variant or "", metric.expr)()


def measure(df: DataFrame, lenses: Sequence[Lens], wanted: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Values of (lens name, metric key, variant) triples: one pass over `df`, long output."""
    return select_metrics(lens_components(class_counts(df, lenses)), wanted)


def select_metrics(components: DataFrame, wanted: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Long (lens, metric_key, variant, value, n_rows) from wide component rows."""
    entries = []
    for lens, key, variant in wanted:
        metric = find_metric(key)
        if metric is None:
            raise KeyError(f"no metric is registered under {key!r}")
        entries.append(F.struct(
            F.lit(lens).alias("wanted_lens"), F.lit(key).alias("metric_key"), F.lit(variant or "").alias("variant"),
            metric_value(metric, variant).cast("double").alias("value"),
        ))
    rows = components.select("lens", F.col("n").cast("bigint").alias("n_rows"), F.inline(F.array(*entries)))
    return rows.filter(F.col("lens") == F.col("wanted_lens")).drop("wanted_lens")
