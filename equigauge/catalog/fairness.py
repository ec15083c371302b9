"""Fairness and performance metrics by group and class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.catalog.frames import A, B, decisions, returns, rounded
from equigauge.catalog.registry import registry
from equigauge.operators.components import Lens, class_counts, class_recall, confusion_long, group_confusion, lens_components
from equigauge.operators.metrics import measure
from equigauge.operators.quality import balance, frequency, group_positive_rates

QUERIES, ORACLES, registered = registry()


_CONFUSION = """
  SELECT {dim} AS grp, count(*) AS n,
    count(*) FILTER (target = 1 AND prediction = 1) AS tp, count(*) FILTER (target = 0 AND prediction = 1) AS fp,
    count(*) FILTER (target = 0 AND prediction = 0) AS tn, count(*) FILTER (target = 1 AND prediction = 0) AS fn
  FROM a WHERE {dim} IS NOT NULL GROUP BY 1"""


@registered(f"""WITH {A}, g AS ({_CONFUSION.format(dim='lang')})
SELECT grp, n, tp, fp, tn, fn, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS tpr,
  round(coalesce(fp / nullif(fp + tn, 0), 0.0), 6) AS fpr, round(coalesce(tn / nullif(tn + fp, 0), 0.0), 6) AS tnr FROM g""")
def group_confusion_rates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(group_confusion(decisions(spark, folder), "lang", "target", "prediction"))


_RATES = """SELECT '{name}' AS dimension, grp, (tp + fp) / n AS sel, coalesce(tp / nullif(tp + fn, 0), 0.0) AS tpr,
  coalesce(fp / nullif(fp + tn, 0), 0.0) AS fpr, coalesce(tn / nullif(tn + fp, 0), 0.0) AS tnr,
  coalesce(tp / nullif(tp + fp, 0), 0.0) AS prec FROM {rel}"""

FAIRNESS_KEYS = (
    "demographic_parity_diff", "disparate_impact", "equal_opportunity_diff", "predictive_equality_diff",
    "equalized_odds_ratio", "true_negative_rate_diff", "predictive_parity",
)

FAIRNESS_SQL = f"""WITH {A}, g1 AS ({_CONFUSION.format(dim='lang')}), g2 AS ({_CONFUSION.format(dim='source')}),
r AS ({_RATES.format(name='lang', rel='g1')} UNION ALL {_RATES.format(name='source', rel='g2')}),
m AS (SELECT dimension, max(sel) - min(sel) AS demographic_parity_diff, min(sel) / nullif(max(sel), 0) AS disparate_impact,
  max(tpr) - min(tpr) AS equal_opportunity_diff, max(fpr) - min(fpr) AS predictive_equality_diff,
  greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS equalized_odds_ratio,
  max(tnr) - min(tnr) AS true_negative_rate_diff, max(prec) - min(prec) AS predictive_parity FROM r GROUP BY dimension)
SELECT dimension, metric_key, round(value, 6) AS value FROM m UNPIVOT INCLUDE NULLS (value FOR metric_key IN ({', '.join(FAIRNESS_KEYS)}))"""


@registered(FAIRNESS_SQL)
def fairness_binary(spark: SparkSession, folder: str) -> DataFrame:
    """Seven metrics over two dimensions from one pass over the joined tables."""
    lenses = [Lens(d, "target", "prediction", (d,)) for d in ("lang", "source")]
    wanted = [(lens.name, key, None) for lens in lenses for key in FAIRNESS_KEYS]
    out = measure(decisions(spark, folder), lenses, wanted)
    return rounded(out.select(F.col("lens").alias("dimension"), "metric_key", "value"))


_MULTI = """
cells{i} AS (SELECT {dim} AS g, prediction AS c, count(*) AS n_pred, count(*) FILTER (target = prediction) AS n_hit FROM b GROUP BY 1, 2),
sizes{i} AS (SELECT {dim} AS g, count(*) AS n FROM b GROUP BY 1),
labels{i} AS (SELECT DISTINCT target AS c FROM b UNION SELECT DISTINCT prediction FROM b),
grid{i} AS (SELECT s.g, l.c, coalesce(x.n_pred, 0) / s.n AS share, x.n_hit / nullif(x.n_pred, 0) AS prec
  FROM sizes{i} s CROSS JOIN labels{i} l LEFT JOIN cells{i} x ON x.g = s.g AND x.c = l.c),
gap{i} AS (SELECT c, max(share) - min(share) AS share_gap, max(prec) - min(prec) AS prec_gap FROM grid{i} GROUP BY c)"""
_MULTI_OUT = """SELECT '{name}' AS dimension, round(max(share_gap), 6) AS parity_max, round(avg(share_gap), 6) AS parity_mean,
  round(max(prec_gap), 6) AS precision_max, round(avg(prec_gap), 6) AS precision_mean FROM gap{i}"""


def _multiclass(spark: SparkSession, folder: str, dims: dict[str, tuple[str, ...]]) -> DataFrame:
    lenses = [Lens(name, "target", "prediction", cols) for name, cols in dims.items()]
    wide = lens_components(class_counts(returns(spark, folder), lenses))
    return rounded(wide.select(
        F.col("lens").alias("dimension"), F.col("share_gap_max").alias("parity_max"),
        F.col("share_gap_mean").alias("parity_mean"), F.col("precision_gap_max").alias("precision_max"),
        F.col("precision_gap_mean").alias("precision_mean"),
    ))


@registered(f"WITH {B}, {_MULTI.format(i=1, dim='status')} {_MULTI_OUT.format(name='status', i=1)}")
def fairness_multiclass(spark: SparkSession, folder: str) -> DataFrame:
    return _multiclass(spark, folder, {"status": ("status",)})


_PAIR = "status || '_' || CAST(line AS VARCHAR)"


@registered(f"WITH {B}, {_MULTI.format(i=1, dim=_PAIR)} {_MULTI_OUT.format(name='status_line', i=1)}")
def intersectional_parity(spark: SparkSession, folder: str) -> DataFrame:
    return _multiclass(spark, folder, {"status_line": ("status", "line")})


_BY_CLASS = """labels AS (SELECT DISTINCT target AS c FROM b UNION SELECT DISTINCT prediction FROM b),
k AS (SELECT c, (SELECT count(*) FROM b WHERE target = c) AS n_true, (SELECT count(*) FROM b WHERE prediction = c) AS n_pred,
  (SELECT count(*) FROM b WHERE target = c AND prediction = c) AS n_hit FROM labels),
r AS (SELECT c, n_true, n_hit, coalesce(n_hit / nullif(n_pred, 0), 0.0) AS p, coalesce(n_hit / nullif(n_true, 0), 0.0) AS q FROM k)"""


@registered(f"""WITH {B}, {_BY_CLASS}
SELECT round(sum(n_hit) / sum(n_true), 6) AS accuracy, round(avg(p), 6) AS precision_macro, round(avg(q), 6) AS recall_macro,
  round(avg(coalesce(2 * p * q / nullif(p + q, 0), 0.0)), 6) AS f1_macro FROM r""")
def performance_macro(spark: SparkSession, folder: str) -> DataFrame:
    wide = lens_components(class_counts(returns(spark, folder), [Lens("all", "target", "prediction")]))
    return rounded(wide.select(
        (F.col("hits") / F.col("n")).alias("accuracy"), "precision_macro", "recall_macro", "f1_macro"
    ))


@registered(f"""WITH {A}, t AS (SELECT target AS y, prediction AS p FROM a UNION ALL SELECT NULL, NULL WHERE false),
x AS (SELECT 'quality' AS task, target AS y, prediction AS p FROM a UNION ALL SELECT 'toxic', toxic, prediction FROM a),
k AS (SELECT task, count(*) AS n, count(*) FILTER (y = p) AS hits, count(*) FILTER (y = 1 AND p = 1) AS tp,
  count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn FROM x GROUP BY task),
r AS (SELECT task, hits / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(tp + fn, 0), 0.0) AS q FROM k)
SELECT task, round(accuracy, 6) AS accuracy_score, round(p, 6) AS precision_score, round(q, 6) AS recall_score,
  round(coalesce(2 * p * q / nullif(p + q, 0), 0.0), 6) AS f1_score FROM r""")
def performance_by_task(spark: SparkSession, folder: str) -> DataFrame:
    """Two target columns judged with one prediction, still one pass."""
    lenses = [Lens("quality", "target", "prediction"), Lens("toxic", "toxic", "prediction")]
    keys = ("accuracy_score", "precision_score", "recall_score", "f1_score")
    out = measure(decisions(spark, folder), lenses, [(x.name, k, None) for x in lenses for k in keys])
    wide = out.groupBy(F.col("lens").alias("task")).agg(
        *[F.max(F.when(F.col("metric_key") == k, F.col("value"))).alias(k) for k in keys]
    )
    return rounded(wide)


@registered(f"WITH {B} SELECT target, prediction, count(*) AS n FROM b GROUP BY 1, 2")
def confusion_matrix_long(spark: SparkSession, folder: str) -> DataFrame:
    return confusion_long(returns(spark, folder), "target", "prediction")


@registered(f"""WITH {B}, l AS (SELECT unnest(['A', 'N', 'R', 'X']) AS label)
SELECT label, count(b.target) AS n, round(coalesce(avg(CASE WHEN b.target = b.prediction THEN 1.0 WHEN b.target IS NOT NULL THEN 0.0 END), 0.0), 6) AS recall
FROM l LEFT JOIN b ON b.target = l.label GROUP BY label""")
def class_recall_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(class_recall(returns(spark, folder), "target", "prediction", ["A", "N", "R", "X"]))


@registered(f"""WITH {A}, k AS (SELECT target, count(*) AS n FROM a WHERE target IS NOT NULL GROUP BY 1)
SELECT round(min(n) / max(n), 6) AS imbalance, round(min(n) / sum(n), 6) AS minority_share, count(*) AS n_values FROM k""")
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(balance(decisions(spark, folder), "target"))


@registered(f"""WITH {A}, k AS (SELECT lang, count(*) AS n FROM a WHERE lang IS NOT NULL GROUP BY 1)
SELECT round(min(n) / max(n), 6) AS imbalance, round(min(n) / sum(n), 6) AS minority_share, count(*) AS n_values FROM k""")
def group_representation(spark: SparkSession, folder: str) -> DataFrame:
    """Balance of a protected column bound in the place of the target."""
    return rounded(balance(decisions(spark, folder), "lang"))


@registered("""SELECT source, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents WHERE source IS NOT NULL), 6) AS share
FROM documents WHERE source IS NOT NULL GROUP BY source""")
def value_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(frequency(spark.read.parquet(f"{folder}/documents.parquet"), "source"))


@registered(f"""WITH {A}, p AS (SELECT CASE WHEN count(DISTINCT target) = 2 THEN max(target) ELSE 1 END AS pos FROM a)
SELECT source AS grp, count(*) AS n, round(coalesce(count(*) FILTER (target = pos) / nullif(count(target), 0), 0.0), 6) AS positive_rate
FROM a, p WHERE source IS NOT NULL GROUP BY source""")
def group_min_positive_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(group_positive_rates(decisions(spark, folder), "target", "source"))
