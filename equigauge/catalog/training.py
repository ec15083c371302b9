"""Samples, splits, weights, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.catalog.frames import A, customers, decisions, rounded, table
from equigauge.catalog.registry import registry
from equigauge.operators import reweigh, sampling
from equigauge.operators.accumulators import CalibrationError, accumulated
from equigauge.operators.frames import one_hot, one_hot_sparse
from equigauge.operators.modelling import AuditedModel
from equigauge.plans.enforce import PolicyViolation, enforce
from equigauge.plans.publish import publish, published, stage, versions
from equigauge.session import settle, shared_folder
from equigauge.sources.policies import Control

QUERIES, ORACLES, registered = registry()


@registered("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 2000")
def sample_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.at_scale(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "POC")


@registered("""SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) AS INTEGER) < 52429 THEN 'train' ELSE 'test' END AS part FROM orders""")
def split_hash(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.hash_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@registered("""SELECT o_orderkey, CASE WHEN rn <= (n * 4 + 4) // 5 THEN 'train' ELSE 'test' END AS part FROM (
SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn, count(*) OVER () AS n FROM orders)""")
def split_exact(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.exact_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@registered("""SELECT o_orderkey, o_orderpriority, o_orderstatus, CASE WHEN rn <= (n * 4 + 4) // 5 THEN 'train' ELSE 'test' END AS part FROM (
SELECT o_orderkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
  count(*) OVER (PARTITION BY o_orderpriority, o_orderstatus) AS n FROM orders)""")
def split_stratified(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return sampling.exact_split(rows, "o_orderkey", 0.8, ["o_orderpriority", "o_orderstatus"])


_WEIGHTS = """k AS (SELECT lang, target, count(*) AS n_cell FROM a GROUP BY 1, 2),
wt AS (SELECT lang, target, sum(n_cell) OVER (PARTITION BY lang) * sum(n_cell) OVER (PARTITION BY target) / (sum(n_cell) OVER () * n_cell) AS weight FROM k)"""


@registered(f"""WITH {A}, {_WEIGHTS} SELECT a.row_key, a.lang, a.target, round(wt.weight, 6) AS weight FROM a JOIN wt ON wt.lang = a.lang AND wt.target = a.target""")
def reweigh_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reweigh.reweighed(decisions(spark, folder).select("row_key", "lang", "target"), "lang", "target"))


@registered(f"""WITH {A}, {_WEIGHTS} SELECT a.lang, round(sum(wt.weight * a.target) / sum(wt.weight), 6) AS weighted_rate
FROM a JOIN wt ON wt.lang = a.lang AND wt.target = a.target GROUP BY a.lang""")
def reweighed_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted rates after reweighing: every group that has all labels shows the overall rate."""
    rows = reweigh.reweighed(decisions(spark, folder), "lang", "target")
    return rounded(reweigh.weighted_rates(rows, "lang", "target", "weight"))


@registered("""WITH c AS (SELECT CAST(i AS INTEGER) AS label, (SELECT count(*) FROM lineitem WHERE l_linenumber = i) AS n FROM range(9) t(i)),
k AS (SELECT d, exp(-0.5 * d * d) / (SELECT sum(exp(-0.5 * e * e)) FROM range(-4, 5) r(e)) AS w FROM range(-4, 5) q(d)),
x AS (SELECT a.label, a.n, sum(k.w * b.n) AS smoothed FROM c a, k, c b
  WHERE b.label = CASE WHEN a.label + d < 0 THEN -a.label - d - 1 WHEN a.label + d > 8 THEN 17 - a.label - d ELSE a.label + d END GROUP BY a.label, a.n)
SELECT label, n, round(smoothed, 4) AS smoothed, round((1 / (smoothed + 1e-6)) / (SELECT min(1 / (smoothed + 1e-6)) FROM x), 4) AS weight FROM x""")
def label_smoothing(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reweigh.smoothed_weights(table(spark, folder, "lineitem"), "l_linenumber", range(9)), 4)


@registered("""SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal_z FROM customer""")
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return rounded(reweigh.standardized(rows, ["c_acctbal"]).drop("c_acctbal"))


@registered("""SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN (SELECT quantile_cont(c_acctbal, 0.5) FROM customer WHERE c_custkey % 10 <> 0) ELSE c_acctbal END AS c_acctbal FROM customer""")
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("c_acctbal")
    )
    return reweigh.median_filled(rows, ["c_acctbal"])


@registered("""SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P FROM orders""")
def one_hot_status(spark: SparkSession, folder: str) -> DataFrame:
    """Dummy columns without the first level."""
    return one_hot(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], drop_first=True)


MODEL_CONTROLS = (
    Control("credit-imbalance", "class_imbalance", "gt", 0.2, target_role="target"),
    Control("fairness", "demographic_parity_diff", "<", 0.10, dimension="segment"),
    Control("accuracy", "accuracy_score", ">=", 0.5),
)


@registered()
def train_score_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Reweighed logistic regression on the training part; audit results over the scored test part."""
    rows = sampling.hash_split(customers(spark, folder), "row_key")
    train = reweigh.reweighed(rows.filter("part = 'train'"), "c_mktsegment", "target")
    model = AuditedModel(
        MODEL_CONTROLS, {"segment": "c_mktsegment"}, "target", ["c_acctbal", "n_nationkey"],
        ["c_mktsegment", "o_orderpriority"], weight="weight",
    ).fit(train)
    model.predict(rows.filter("part = 'test'"))
    return model.last_audit.results.drop("groups")


@registered(f"""WITH {A}, p AS (SELECT *, CAST('0x' || substr(md5(CAST(row_key AS VARCHAR)), 1, 4) AS INTEGER) < 52429 AS training, 1 + (row_key % 7) * 0.1 + n_chars * 1e-5 AS w FROM a),
r AS (SELECT source, sum(w * target) / sum(w) AS rate FROM p WHERE training GROUP BY source)
SELECT p.row_key, p.source, p.target, CAST(r.rate > 0.5 AS INTEGER) AS prediction FROM p JOIN r ON p.source = r.source WHERE NOT p.training""")
def score_by_source(spark: SparkSession, folder: str) -> DataFrame:
    """A weighted logistic regression on one category gives every row the class of its category's weighted rate."""
    weight = 1 + (F.col("row_key") % 7) * 0.1 + F.col("n_chars") * 1e-5
    rows = sampling.hash_split(decisions(spark, folder).select("row_key", "source", "target", weight.alias("weight")), "row_key")
    model = AuditedModel(MODEL_CONTROLS[2:], {}, "target", [], ["source"], weight="weight").fit(rows.filter("part = 'train'"))
    return model.predict(rows.filter("part = 'test'")).select("row_key", "source", "target", "prediction")


_SPLIT_RATES = f"""{A}, p AS (SELECT *, CAST('0x' || substr(md5(CAST(row_key AS VARCHAR)), 1, 4) AS INTEGER) < 52429 AS training, 1 + (row_key % 7) * 0.1 + n_chars * 1e-5 AS w FROM a),
r AS (SELECT source, sum(w * target) / sum(w) AS rate FROM p WHERE training GROUP BY source),
scored AS (SELECT p.row_key, p.source, p.lang, p.target, CAST(r.rate > 0.5 AS INTEGER) AS prediction FROM p JOIN r ON p.source = r.source WHERE NOT p.training)"""
SCORED_CONTROLS = (
    Control("balance", "class_imbalance", "gt", 0.2, target_role="target"), Control("accuracy", "accuracy_score", ">=", 0.4),
    Control("language", "demographic_parity_diff", "<", 0.5, dimension="lang"), Control("source", "demographic_parity_diff", "<", 0.9, dimension="source"),
)


def _source_model(spark: SparkSession, folder: str, controls: tuple) -> tuple[AuditedModel, DataFrame]:
    weight = 1 + (F.col("row_key") % 7) * 0.1 + F.col("n_chars") * 1e-5
    rows = sampling.hash_split(decisions(spark, folder).select("row_key", "source", "lang", "target", weight.alias("weight")), "row_key")
    model = AuditedModel(controls, {"lang": "lang", "source": "source"}, "target", [], ["source"], weight="weight")
    return model.fit(rows.filter("part = 'train'")), rows.filter("part = 'test'").drop("part")


@registered(f"""WITH {_SPLIT_RATES},
i AS (SELECT training, count(*) FILTER (target = 1) AS a, count(*) FILTER (target = 0) AS b FROM p GROUP BY training),
m AS (SELECT 'post' AS phase, 'balance' AS control_id, (SELECT least(a, b) / greatest(a, b) FROM i WHERE NOT training) AS v, 0.2 AS t
UNION ALL SELECT 'pre', 'balance', (SELECT least(a, b) / greatest(a, b) FROM i WHERE training), 0.2
UNION ALL SELECT 'post', 'accuracy', (SELECT avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END) FROM scored), 0.4
UNION ALL SELECT 'post', 'language', (SELECT max(x) - min(x) FROM (SELECT avg(prediction) AS x FROM scored GROUP BY lang)), 0.5
UNION ALL SELECT 'pre', 'language', (SELECT max(x) - min(x) FROM (SELECT avg(target) AS x FROM p WHERE training GROUP BY lang)), 0.5
UNION ALL SELECT 'post', 'source', (SELECT max(x) - min(x) FROM (SELECT avg(prediction) AS x FROM scored GROUP BY source)), 0.9
UNION ALL SELECT 'pre', 'source', (SELECT max(x) - min(x) FROM (SELECT avg(target) AS x FROM p WHERE training GROUP BY source)), 0.9)
SELECT phase, control_id, round(v, 6) AS actual_value, CASE control_id WHEN 'balance' THEN v > t WHEN 'accuracy' THEN v >= t ELSE v < t END AS passed FROM m""")
def scored_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of the training rows before the fit and of the scored rows after it."""
    model, test = _source_model(spark, folder, SCORED_CONTROLS)
    model.predict(test)
    both = model.data_audit.results.unionByName(model.last_audit.results)
    return rounded(both.select("phase", "control_id", "actual_value", "passed"))


@registered(f"""WITH {_SPLIT_RATES}, s AS (SELECT count(*) AS n, count(*) FILTER (prediction = 1) AS ones FROM scored)
SELECT step, blocked, visible, n AS n_visible, CASE visible WHEN 'second' THEN n ELSE ones END AS positives
FROM s, (VALUES ('first', false, 'first'), ('second', true, 'first'), ('second again', false, 'second')) t(step, blocked, visible)""")
def publish_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores that readers see: a run that fails its gate leaves them on the run before until it is staged again."""
    path = shared_folder(spark, "scores")
    model, test = _source_model(spark, folder, (Control("accuracy", "accuracy_score", ">=", 0.0),))
    model.publish(test, path, "first")
    seen = [_visible(spark, path, "first", False)]
    everyone = model._scored(test).withColumn("prediction", F.lit(1))
    for step, control in (("second", Control("impossible", "accuracy_score", ">", 1.0)), ("second again", Control("possible", "accuracy_score", ">=", 0.0))):
        results = enforce(stage(everyone, path, "second"), [control], target="target", prediction="prediction").results
        try:
            publish(path, "second", results)
            blocked = False
        except PolicyViolation:
            blocked = True
        seen.append(_visible(spark, path, step, blocked))
    return seen[0].union(seen[1]).union(seen[2])


def _visible(spark: SparkSession, path: str, step: str, blocked: bool) -> DataFrame:
    """What readers have after a step, kept as it was then."""
    newest = versions(spark, path).agg(F.max_by("run_id", "version")).first()[0]
    return settle(published(spark, path).agg(
        F.lit(step).alias("step"), F.lit(blocked).alias("blocked"), F.lit(newest).alias("visible"),
        F.count(F.lit(1)).alias("n_visible"), F.count_if(F.col("prediction") == 1).alias("positives")))


@registered("""WITH l AS (SELECT row_number() OVER (ORDER BY name, level) AS g, row_number() OVER (PARTITION BY name ORDER BY level) AS k, name, level
  FROM (SELECT DISTINCT 'o_orderpriority' AS name, o_orderpriority AS level FROM orders UNION SELECT DISTINCT 'o_orderstatus', o_orderstatus FROM orders)),
q AS (SELECT name, level, CASE WHEN k > 1 THEN sum(CASE WHEN k > 1 THEN 1 ELSE 0 END) OVER (ORDER BY g) - 1 END AS at FROM l)
SELECT o_orderkey, concat_ws(',', CAST(a.at AS VARCHAR), CAST(b.at AS VARCHAR)) AS positions FROM orders
LEFT JOIN q a ON a.name = 'o_orderpriority' AND a.level = o_orderpriority LEFT JOIN q b ON b.name = 'o_orderstatus' AND b.level = o_orderstatus""")
def one_hot_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Which of all levels of two columns a row has, the first level of each left out."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sparse = one_hot_sparse(rows, ["o_orderpriority", "o_orderstatus"], drop_first=True, out="positions")
    return sparse.withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), ","))


@registered("""WITH s AS (SELECT event_type AS grp, least(greatest(value / 120.0, 0.0), 1.0) AS score, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS y FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL),
b AS (SELECT grp, least(floor(score * 10), 9) AS bin, abs(sum(score) - sum(y)) AS off, count(*) AS n FROM s GROUP BY 1, 2)
SELECT grp, round(sum(off) / sum(n), 6) AS value FROM b GROUP BY grp""")
def calibration_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """A metric with a state of its own, bins of a score, per group."""
    score = F.least(F.greatest(F.col("value") / 120.0, F.lit(0.0)), F.lit(1.0))
    rows = table(spark, folder, "events").select(F.col("event_type").alias("grp"), score.alias("score"), F.when(F.col("user_id") % 3 == 0, 1).otherwise(0).alias("y"))
    return rounded(accumulated(rows, ["grp"], CalibrationError("score", "y")))
