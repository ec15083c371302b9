"""Policies enforced on the tables, and what is made of the results."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.catalog.fairness import _CONFUSION
from equigauge.catalog.frames import A, decisions, rounded, table
from equigauge.catalog.registry import registry
from equigauge.catalog.volumes import COHORT_SQL, cohort_rows
from equigauge.operators.frames import combine
from equigauge.plans import provenance, report
from equigauge.plans.enforce import enforce, enforce_metrics
from equigauge.sources.policies import Control, raw_texts, resolve

QUERIES, ORACLES, registered = registry()

POLICIES = Path(__file__).parent / "policies"


INLINE = (
    Control("accuracy", "accuracy_score", ">=", 0.45, description="Share of right decisions"),
    Control("parity", "demographic_parity_diff", "<", 0.10, dimension="lang", severity="high", article="10"),
    Control("impact", "disparate_impact", "gt", 0.80, dimension="lang", severity="high", article="10"),
    Control("opportunity", "equal_opportunity_diff", "lt", 0.15, dimension="lang", article="15"),
    Control("odds", "equalized_odds_ratio", "<", 0.20, dimension="lang", article="15"),
    Control("precision-parity", "predictive_parity", "<", 0.12, dimension="source", article="15"),
    Control("balance", "class_imbalance", "gt", 0.4, article="10"),
)


def audit(spark: SparkSession, folder: str) -> DataFrame:
    return enforce(decisions(spark, folder), INLINE, target="target", prediction="prediction").results


_GROUP_RATES = """SELECT (tp + fp) / n AS sel, coalesce(tp / nullif(tp + fn, 0), 0.0) AS tpr, coalesce(fp / nullif(fp + tn, 0), 0.0) AS fpr,
  coalesce(tp / nullif(tp + fp, 0), 0.0) AS prec FROM {rel}"""

AUDIT = f"""{A}, g1 AS ({_CONFUSION.format(dim='lang')}), g2 AS ({_CONFUSION.format(dim='source')}),
r1 AS ({_GROUP_RATES.format(rel='g1')}), r2 AS ({_GROUP_RATES.format(rel='g2')}),
cl AS (SELECT target, count(*) AS n FROM a GROUP BY 1),
au AS (SELECT 'accuracy' AS control_id, 'accuracy_score' AS metric_key, '>=' AS operator, 0.45::DOUBLE AS threshold, 'medium' AS severity, (SELECT avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END) FROM a)::DOUBLE AS v
UNION ALL SELECT 'parity', 'demographic_parity_diff', '<', 0.10, 'high', (SELECT max(sel) - min(sel) FROM r1)
UNION ALL SELECT 'impact', 'disparate_impact', 'gt', 0.80, 'high', (SELECT min(sel) / nullif(max(sel), 0) FROM r1)
UNION ALL SELECT 'opportunity', 'equal_opportunity_diff', 'lt', 0.15, 'medium', (SELECT max(tpr) - min(tpr) FROM r1)
UNION ALL SELECT 'odds', 'equalized_odds_ratio', '<', 0.20, 'medium', (SELECT greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) FROM r1)
UNION ALL SELECT 'precision-parity', 'predictive_parity', '<', 0.12, 'medium', (SELECT max(prec) - min(prec) FROM r2)
UNION ALL SELECT 'balance', 'class_imbalance', 'gt', 0.4, 'medium', (SELECT min(n) / max(n) FROM cl)),
res AS (SELECT *, CASE WHEN operator IN ('gt', '>') THEN v > threshold WHEN operator IN ('lt', '<') THEN v < threshold
  WHEN operator = '>=' THEN v >= threshold END AS passed FROM au)"""

_SHOWN = "CASE operator WHEN 'gt' THEN '>' WHEN 'lt' THEN '<' ELSE operator END"


@registered(f"""WITH {AUDIT} SELECT control_id, metric_key, round(v, 6) AS actual_value, operator, threshold, passed, severity,
  printf('%.4f ', v) || {_SHOWN} || printf(' %.4f', threshold) AS message, true AS evaluated FROM res""")
def enforce_table(spark: SparkSession, folder: str) -> DataFrame:
    """Seven controls over two dimensions, one pass over the data."""
    return rounded(audit(spark, folder).select(
        "control_id", "metric_key", "actual_value", "operator", "threshold", "passed", "severity", "message", "evaluated"
    ))


@registered(f"""WITH {A}, g AS ({_CONFUSION.format(dim='lang')}), r AS ({_GROUP_RATES.format(rel='g')}), k AS (SELECT min(n) AS k FROM (SELECT count(*) AS n FROM a GROUP BY lang, source)),
y AS (SELECT source, count(*) FILTER (target = 1) / count(*) AS rate FROM a GROUP BY source), cl AS (SELECT target, count(*) AS n FROM a GROUP BY 1),
m AS (SELECT 'decisions' AS policy_id, 'req-parity' AS requirement_id, 'F.1' AS control_id, 'demographic_parity_diff' AS metric_key, (SELECT max(sel) - min(sel) FROM r) AS v, '<' AS operator, 0.20::DOUBLE AS threshold, 'high' AS severity
UNION ALL SELECT 'decisions', 'req-odds', 'F.1', 'equalized_odds_ratio', (SELECT greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) FROM r), '<', 0.10, 'high'
UNION ALL SELECT 'decisions', 'req-accuracy', 'P.1', 'accuracy_score', (SELECT avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END) FROM a), '>=', 0.40, 'medium'
UNION ALL SELECT 'decisions', 'req-anonymity', 'B.1', 'k_anonymity', (SELECT k FROM k), '>=', 2, 'medium'
UNION ALL SELECT 'labels', 'req-imbalance', 'class-imbalance-check', 'class_imbalance', (SELECT min(n) / max(n) FROM cl), 'gt', 0.4, 'medium'
UNION ALL SELECT 'labels', 'req-rate', 'positive-rate-by-source', 'group_min_positive_rate', (SELECT min(rate) FROM y), 'gt', 0.25, 'medium'
UNION ALL SELECT 'labels', 'req-complete', 'completeness-check', 'data_completeness', (SELECT (count(target) + count(nullif(trim(lang), '')) + count(nullif(trim(source), ''))) / (3 * count(*)) FROM a), 'gt', 0.9, 'medium'
UNION ALL SELECT 'labels', 'req-income', 'income-diversity', 'l_diversity', NULL, '>=', 2, 'medium')
SELECT policy_id, requirement_id, control_id, metric_key, round(v, 6) AS actual_value, operator, threshold, severity,
  coalesce(CASE WHEN metric_key = 'group_min_positive_rate' THEN v >= threshold WHEN operator IN ('gt', '>') THEN v > threshold WHEN operator = '<' THEN v < threshold ELSE v >= threshold END, false) AS passed,
  v IS NOT NULL AS evaluated FROM m""")
def enforce_policy_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two policy documents of different shape on one table; a control without its column is not evaluated."""
    texts = {p.name.split(".")[0]: p.read_text() for p in sorted(POLICIES.glob("*.yaml"))}
    policy = resolve(raw_texts(spark, texts))
    run = enforce(decisions(spark, folder), policy, target="target", prediction="prediction", language="lang")
    return rounded(run.results.select(
        "policy_id", "requirement_id", "control_id", "metric_key", "actual_value", "operator", "threshold", "severity",
        "passed", "evaluated",
    ))


COHORT_CONTROLS = (
    Control("sex", "minority_sex_prop", "gt", 0.30, severity="high", article="10"),
    Control("scanner", "min_scanner_dice", "gt", 0.60, severity="high", article="15"),
    Control("small", "small_vol_dice", "gt", 0.75, severity="critical", article="15"),
    Control("global", "global_dice", "gt", 0.65, severity="critical", article="15"),
    Control("gap", "gender_gap", "lt", 0.05, severity="high", article="15"),
    Control("leak", "max_single_dice", "lt", 0.99, severity="critical", article="15"),
    Control("calibration", "confidence_correlation", "gt", 0.5, severity="medium", article="15"),
    Control("absent", "mean_surface_distance", "lt", 2.0, severity="medium", article="15"),
)
_COHORT_ROWS = ", ".join(
    f"('{c.control_id}', '{c.metric_key}', '{c.operator}', {c.threshold}, '{c.severity}')" for c in COHORT_CONTROLS
)


@registered(f"""WITH {COHORT_SQL}, ct AS (SELECT * FROM (VALUES {_COHORT_ROWS}) t(control_id, metric_key, operator, threshold, severity))
SELECT control_id, metric_key, round(value, 6) AS actual_value, CAST(threshold AS DOUBLE) AS threshold,
  coalesce(CASE operator WHEN 'gt' THEN value > threshold ELSE value < threshold END, false) AS passed, value IS NOT NULL AS evaluated
FROM ct LEFT JOIN u USING (metric_key)""")
def enforce_metrics_table(spark: SparkSession, folder: str) -> DataFrame:
    """Controls over the precomputed cohort dictionary."""
    results = enforce_metrics(cohort_rows(spark, folder), COHORT_CONTROLS)
    return rounded(results.select("control_id", "metric_key", "actual_value", "threshold", "passed", "evaluated"))


@registered(f"""WITH {AUDIT} SELECT severity, count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  round(100.0 * count(*) FILTER (passed) / count(*), 6) AS percentage, bool_and(passed) AS overall_pass FROM res GROUP BY severity""")
def audit_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(report.summary(audit(spark, folder), "severity"))


@registered(f"""WITH {AUDIT} SELECT key, round(CAST(value AS DOUBLE), 6) AS value FROM (
SELECT 'post_training.governance.' || control_id || '.pass' AS key, CASE WHEN passed THEN 1.0 ELSE 0.0 END AS value FROM res
UNION ALL SELECT 'post_training.governance.' || control_id || '.value', v FROM res
UNION ALL SELECT 'post_training.governance.' || control_id || '.threshold', threshold FROM res
UNION ALL SELECT 'post_training.metrics.' || metric_key, v FROM res
UNION ALL SELECT 'governance.overall_pass', CASE WHEN bool_and(passed) THEN 1.0 ELSE 0.0 END FROM res)""")
def metric_log(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(report.metric_log(audit(spark, folder), "post_training"))


@registered(f"""WITH {AUDIT} SELECT control_id AS requirement_id, '| ' || control_id || ' | ' || CASE WHEN passed THEN '✅' ELSE '❌' END || ' | ' || printf('%.3f', v) || ' | ' || CAST(threshold AS VARCHAR) || ' |' AS line FROM res""")
def report_rows(spark: SparkSession, folder: str) -> DataFrame:
    return report.report_rows(audit(spark, folder))


@registered(f"""WITH {AUDIT} SELECT control_id, CASE WHEN metric_key IN ('accuracy_score', 'class_imbalance', 'disparate_impact') THEN 'calculated' WHEN v <= 0.1 THEN 'low' WHEN v <= 0.2 THEN 'medium' ELSE 'high' END AS risk,
  v IN (0.0, 1.0) AS suspicious, v IS NULL AS missing_value FROM res""")
def risk_bands(spark: SparkSession, folder: str) -> DataFrame:
    return report.findings(audit(spark, folder)).select("control_id", "risk", "suspicious", "missing_value")


def _fair(rows: DataFrame) -> DataFrame:
    """The same audit with a rule that takes the median length as its limit."""
    return rows.withColumn("prediction", F.when(F.col("n_chars") < 2500, 1).otherwise(0))


_RUN = """g{i} AS (SELECT lang, avg(p) AS sel FROM x{i} GROUP BY lang),
m{i} AS (SELECT 'accuracy' AS requirement_id, avg(CASE WHEN target = p THEN 1.0 ELSE 0.0 END)::DOUBLE AS v FROM x{i} UNION ALL SELECT 'parity', max(sel) - min(sel) FROM g{i})"""


@registered(f"""WITH {A}, x1 AS (SELECT target, lang, prediction AS p FROM a), x2 AS (SELECT target, lang, CASE WHEN n_chars < 2500 THEN 1 ELSE 0 END AS p FROM a),
{_RUN.format(i=1)}, {_RUN.format(i=2)}
SELECT requirement_id, CASE requirement_id WHEN 'accuracy' THEN 'accuracy_score' ELSE 'demographic_parity_diff' END AS metric_key,
  round(m1.v, 6) AS before_value, round(m2.v, 6) AS after_value, round(m2.v - m1.v, 6) AS delta,
  CASE requirement_id WHEN 'accuracy' THEN m1.v >= 0.45 ELSE m1.v < 0.10 END AS before_passed,
  CASE requirement_id WHEN 'accuracy' THEN m2.v >= 0.45 ELSE m2.v < 0.10 END AS after_passed FROM m1 JOIN m2 USING (requirement_id)""")
def run_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline against a changed decision rule."""
    rows = decisions(spark, folder)
    before = enforce(rows, INLINE[:2], target="target", prediction="prediction").results
    after = enforce(_fair(rows), INLINE[:2], target="target", prediction="prediction").results
    return rounded(report.compare_runs(before, after).drop("policy_id"))


@registered(f"""WITH {A}, cl AS (SELECT target, count(*) AS n FROM a GROUP BY 1)
SELECT 'pre' AS phase, 'balance' AS control_id, round(min(n) / max(n), 6) AS actual_value FROM cl
UNION ALL SELECT 'post', 'accuracy', round(avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END), 6) FROM a""")
def audits_combined(spark: SparkSession, folder: str) -> DataFrame:
    """Results before and after training in one table."""
    rows = decisions(spark, folder)
    pre = enforce(rows, INLINE[6:7], target="target").results
    post = enforce(rows, INLINE[:1], target="target", prediction="prediction").results
    return rounded(combine(pre, post, phases=["pre", "post"]).select("phase", "control_id", "actual_value"))


def _cells_sql(columns: tuple[str, ...]) -> str:
    return " || ".join(
        f"coalesce('{c}=' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '{c}!')" for c in columns)


def leaves_sql(rel: str, columns: tuple[str, ...], keys: tuple[str, ...], name: str = "leaves") -> str:
    """The leaves of a fingerprint: sums of sixteen 64-bit numbers per part, hashed."""
    lanes = [f"CAST('0x' || substr(sha256('{k}|' || row), {1 + 16 * j}, 16) AS UBIGINT)" for k in range(4) for j in range(4)]
    sums = " || ',' || ".join(f"CAST(CAST(sum({x}) AS HUGEINT) AS VARCHAR)" for x in lanes)
    return f"""{name}_rows AS (SELECT {_cells_sql(columns)} AS row, CAST('0x' || substr(sha256({_cells_sql(keys)}), 1, 2) AS INTEGER) AS part FROM {rel}),
{name} AS (SELECT part, count(*) AS n_rows, sha256(CAST(count(*) AS VARCHAR) || ',' || {sums}) AS part_hash FROM {name}_rows GROUP BY part)"""


def _root_sql(columns: tuple[str, ...], rel: str, name: str = "leaves") -> str:
    return f"""{leaves_sql(rel, columns, columns, name)},
{name}_up AS (SELECT part // 16 AS node, sum(n_rows) AS n_rows, sha256(string_agg(part || ':' || part_hash, ',' ORDER BY part)) AS hash FROM {name} GROUP BY 1),
{name}_top AS (SELECT CAST(sum(n_rows) AS BIGINT) AS n_rows, sha256(string_agg(node || ':' || hash, ',' ORDER BY node)) AS data_hash FROM {name}_up)"""


@registered(f"""WITH {_root_sql(('doc_id', 'lang', 'source'), 'documents')} SELECT n_rows, data_hash FROM leaves_top""")
def fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return provenance.fingerprint(table(spark, folder, "documents"), ["doc_id", "lang", "source"])


@registered(f"""WITH {_root_sql(('o_orderkey', 'o_orderstatus', 'o_orderpriority'), 'orders')} SELECT 'run-1' AS run_id, n_rows, data_hash, 'None' AS mitigation FROM leaves_top""")
def run_record(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return provenance.run_record(table(spark, folder, "orders"), "run-1", columns=keys).drop("timestamp")


@registered("""WITH d AS (SELECT doc_id, lang, CAST('0x' || substr(sha256('doc_id=' || length(CAST(doc_id AS VARCHAR)) || ':' || doc_id), 1, 2) AS INTEGER) AS part FROM documents)
SELECT part, count(*) AS rows_before, count(*) FILTER (doc_id % 97 <> 5) AS rows_after FROM d
GROUP BY part HAVING count(*) FILTER (doc_id % 97 = 5 OR (doc_id % 89 = 3 AND lang <> 'xx')) > 0""")
def fingerprint_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Which parts of a table differ from an earlier version of it: some rows are gone and some have another language."""
    before = table(spark, folder, "documents").select("doc_id", "lang", "source")
    after = before.filter("doc_id % 97 <> 5").withColumn("lang", F.when(F.col("doc_id") % 89 == 3, "xx").otherwise(F.col("lang")))
    leaves = [provenance.fingerprint_parts(version, keys=["doc_id"]) for version in (before, after)]
    return provenance.changed_parts(*leaves)


@registered("""SELECT CAST(o_custkey AS VARCHAR) AS grp, count(*) AS n, round(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END), 6) AS positive_rate
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey""")
def group_rates_all(spark: SparkSession, folder: str) -> DataFrame:
    """The rates of all groups of a group-rate control, here one per customer."""
    rows = table(spark, folder, "orders").select("o_custkey", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"))
    control = Control("urgent", "group_min_positive_rate", "gt", 0.0, dimension="o_custkey")
    return rounded(enforce(rows, [control], target="urgent").least_rates.select("grp", "n", "positive_rate"))
