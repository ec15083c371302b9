"""Policies as documents in folders, strict mode, own metrics, and the small steps before an audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.catalog.frames import A, decisions, rounded, table
from equigauge.catalog.registry import registry
from equigauge.functions.judge import compare
from equigauge.operators import frames, sampling, volumes
from equigauge.operators.metrics import metric_catalogue
from equigauge.plans.enforce import SCALAR_METRICS, NotEvaluable, enforce, scalar_metric
from equigauge.session import shared_folder
from equigauge.sources import tables
from equigauge.sources.policies import Control, raw_texts, read_policies, resolve

QUERIES, ORACLES, registered = registry()

_PROPS = "[{name: metric_key, value: solvent_share}, {name: operator, value: '%s'}, {name: threshold, value: '%.2f'}, {name: severity, value: high}]"
#: One document of each shape: where its requirement stands, and its text around the properties.
SHAPES = (
    ("system-security-plan/control-implementation/implemented-requirements",
     "system-security-plan: {control-implementation: {implemented-requirements: [{uuid: r, control-id: C, props: %s}]}}"),
    ("assessment-plan/control-implementations/implemented-requirements",
     "assessment-plan: {control-implementations: [{description: d, implemented-requirements: [{uuid: r, control-id: C, props: %s}]}]}"),
    ("assessment-plan/reviewed-controls/control-selections/include-controls",
     "assessment-plan: {reviewed-controls: {control-selections: [{include-controls: [{uuid: r, control-id: C, props: %s}]}]}}"),
    ("assessment-plan/reviewed-controls/control-implementations/implemented-requirements",
     "assessment-plan: {reviewed-controls: {control-implementations: [{implemented-requirements: [{uuid: r, control-id: C, props: %s}]}]}}"),
    ("catalog/control-implementations/implemented-requirements/implemented-requirements",
     "catalog: {inventory-items: [{uuid: m, props: %s}], control-implementations: [{implemented-requirements: "
     "[{uuid: o, control-id: C, description: d, implemented-requirements: [{uuid: r, control-id: C, links: [{href: '#m'}]}]}]}]}"),
    ("catalog/controls/controls", "catalog: {controls: [{id: top, controls: [{uuid: r, id: C, title: t, props: %s}]}]}"),
)
_SHAPE_ROWS = ", ".join(f"({k}, '{shape}')" for k, (shape, _) in enumerate(SHAPES))


@registered(f"""WITH s AS (SELECT * FROM (VALUES {_SHAPE_ROWS}) t(k, shape)),
v AS (SELECT c_nationkey AS nation, avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) AS value FROM customer GROUP BY 1)
SELECT CAST(n_nationkey AS BIGINT) AS nation, shape, 'C' AS control_id, 'high' AS severity, CASE WHEN n_nationkey % 2 = 0 THEN '>=' ELSE 'lt' END AS operator,
  round(0.7 + n_nationkey / 100.0, 2)::DOUBLE AS threshold, round(value, 6) AS value,
  CASE WHEN n_nationkey % 2 = 0 THEN value >= round(0.7 + n_nationkey / 100.0, 2)::DOUBLE ELSE value < round(0.7 + n_nationkey / 100.0, 2)::DOUBLE END AS passed
FROM nation JOIN s ON s.k = n_nationkey % 6 LEFT JOIN v ON v.nation = n_nationkey""")
def policy_controls(spark: SparkSession, folder: str) -> DataFrame:
    """A folder with one policy per nation, in six shapes, read by Spark and joined to what the customers of each show."""
    key = F.col("n_nationkey")
    props = F.format_string(_PROPS, F.when(key % 2 == 0, ">=").otherwise("lt"), F.round(0.7 + key / 100.0, 2))
    text = None
    for k, (_, shape) in enumerate(SHAPES):
        filled = F.format_string(shape, props)
        text = F.when(key % len(SHAPES) == k, filled) if text is None else text.when(key % len(SHAPES) == k, filled)
    path = shared_folder(spark, "policy-folder")
    table(spark, folder, "nation").select(text.alias("value"), key.alias("nation")).write.partitionBy("nation").text(path)
    controls = read_policies(spark, path).withColumn("nation", F.regexp_extract("policy_id", r"nation=(\d+)", 1).cast("long"))
    customer = table(spark, folder, "customer")
    shares = customer.groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(F.avg((F.col("c_acctbal") > 0).cast("double")).alias("value"))
    joined = controls.join(shares, "nation", "left")
    return joined.select("nation", "shape", "control_id", "severity", "operator", "threshold", F.round("value", 6).alias("value"),
                         compare(F.col("value"), F.col("operator"), F.col("threshold")).alias("passed"))


GAPS = """
catalog:
  inventory-items:
    - {uuid: no-metric, description: an item without a metric, props: [{name: severity, value: high}]}
  control-implementations:
    - implemented-requirements:
        - {uuid: lost, control-id: G.1, links: [{href: "#nowhere"}]}
        - {uuid: unknown, control-id: G.2, props: [{name: metric_key, value: no_such_metric}, {name: operator, value: "<"}, {name: threshold, value: "1"}]}
        - {uuid: missing, control-id: G.3, props: [{name: metric_key, value: disparate_impact}, {name: "input:dimension", value: no_such_column}, {name: operator, value: gt}, {name: threshold, value: "0.8"}]}
        - {uuid: kept, control-id: G.4, props: [{name: metric_key, value: accuracy_score}, {name: operator, value: ">="}, {name: threshold, value: "0.4"}]}
        - {uuid: misspelt, control-id: G.5, props: [{name: metric-key, value: accuracy_score}, {name: operator, value: ">="}, {name: threshold, value: "0.4"}]}
        - {uuid: bare, control-id: G.6, props: [{name: operator, value: ">="}, {name: threshold, value: "0.4"}]}
        - {uuid: empty-item, control-id: G.7, links: [{href: "#no-metric"}]}
        - {uuid: no-limit, control-id: G.8, props: [{name: metric_key, value: accuracy_score}, {name: operator, value: ">="}]}
        - {uuid: odd-operator, control-id: G.9, props: [{name: metric_key, value: accuracy_score}, {name: operator, value: about}, {name: threshold, value: "0.4"}]}
"""
_GAP_ROWS = """('lost', 'unresolved_link:#nowhere'), ('unknown', 'unknown metric ''no_such_metric'''),
('missing', 'dimension column ''no_such_column'' is not in the table'), ('kept', NULL), ('misspelt', 'no_metric_key'), ('bare', 'no_metric_key'),
('empty-item', 'no_metric_key'), ('no-limit', 'no threshold is given'), ('odd-operator', 'unknown operator ''about''')"""


@registered(f"""WITH {A}, v AS (SELECT avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END) AS v FROM a)
SELECT requirement_id, why IS NULL AS evaluated, why IS NULL AND v >= 0.4 AS passed,
  CASE WHEN why IS NULL THEN round(v, 6) END AS actual_value, why AS reason FROM v, (VALUES {_GAP_ROWS}) t(requirement_id, why)""")
def policy_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Controls with a lost link, an unknown or missing metric, column, operator or limit stay in the audit, not evaluated."""
    policy = resolve(raw_texts(spark, {"gaps": GAPS}))
    results = enforce(decisions(spark, folder), policy, target="target", prediction="prediction").results
    reason = F.when(~F.col("evaluated"), F.col("message")).alias("reason")
    return rounded(results.select("requirement_id", "evaluated", "passed", "actual_value", reason))


@registered(f"""WITH {A}, v AS (SELECT avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END) AS v FROM a)
SELECT requirement_id, why IS NOT NULL AS refused, CASE WHEN why IS NULL THEN round(v, 6) END AS actual_value FROM v, (VALUES {_GAP_ROWS}) t(requirement_id, why)""")
def strict_mode(spark: SparkSession, folder: str) -> DataFrame:
    """Each control of the same policy in strict mode, alone: refused before anything is read, or evaluated."""
    rows = decisions(spark, folder)
    ids = [r[0] for r in resolve(raw_texts(spark, {"gaps": GAPS})).select("requirement_id").orderBy("requirement_id").collect()]
    out, refused = None, []
    for one in ids:
        policy = resolve(raw_texts(spark, {"gaps": GAPS})).filter(F.col("requirement_id") == one)
        try:
            run = enforce(rows, policy, target="target", prediction="prediction", strict=True).results
        except NotEvaluable:
            refused.append((one, True, None))
            continue
        run = run.select("requirement_id", F.lit(False).alias("refused"), "actual_value")
        out = run if out is None else out.union(run)
    told = spark.createDataFrame(refused, "requirement_id string, refused boolean, actual_value double")
    return rounded(told if out is None else told.union(out))


KEYED = (
    Control("flag", "accuracy_score_flag", ">", 0.3), Control("recall", "recall_score_flag", ">", 0.3, average="macro"),
    Control("late", "precision_score_late", ">", 0.9), Control("late-f1", "f1_score_late", ">", 0.9),
    Control("mean", "column_mean", "<", 0.06, target_role="discount"), Control("absent", "accuracy_score_absent", ">", 0.5),
)


@registered("""WITH k AS (SELECT l_returnflag AS y, CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS p,
  CASE WHEN l_tax > 0.03 THEN 1 ELSE 0 END AS yl, CASE WHEN l_tax > 0.02 THEN 1 ELSE 0 END AS pl, l_discount AS d FROM lineitem),
r AS (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS x FROM k GROUP BY y),
m AS (SELECT count(*) FILTER (yl = 1 AND pl = 1) AS tp, count(*) FILTER (yl = 0 AND pl = 1) AS fp, count(*) FILTER (yl = 1 AND pl = 0) AS fn FROM k),
v AS (SELECT 'flag' AS control_id, (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FROM k) AS v, 0.3 AS t UNION ALL SELECT 'recall', (SELECT avg(x) FROM r), 0.3
UNION ALL SELECT 'late', (SELECT tp / (tp + fp) FROM m), 0.9 UNION ALL SELECT 'late-f1', (SELECT 2.0 * tp / (2 * tp + fp + fn) FROM m), 0.9
UNION ALL SELECT 'mean', (SELECT avg(d) FROM k), 0.06 UNION ALL SELECT 'absent', NULL, 0.5)
SELECT control_id, round(v, 6) AS actual_value, coalesce(CASE WHEN control_id = 'mean' THEN v < t ELSE v > t END, false) AS passed, v IS NOT NULL AS evaluated FROM v""")
def metric_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that name a task by their suffix, and the mean of a column; a task without columns is not evaluated."""
    q = F.col("l_quantity")
    rows = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("target_flag"), F.when(q < 17, "A").when(q < 34, "N").otherwise("R").alias("prediction_flag"),
        F.when(F.col("l_tax") > 0.03, 1).otherwise(0).alias("target_late"), F.when(F.col("l_tax") > 0.02, 1).otherwise(0).alias("prediction_late"),
        F.col("l_discount").alias("discount"))
    return rounded(enforce(rows, KEYED).results.select("control_id", "actual_value", "passed", "evaluated"))


BUCKETS = """
system-security-plan:
  control-implementation:
    implemented-requirements:
      - uuid: by-balance
        control-id: R.1
        props:
          - {name: metric_key, value: group_min_positive_rate}
          - {name: operator, value: gt}
          - {name: threshold, value: "0.1"}
          - {name: "input:dimension", value: balance}
          - {name: age_bucket_method, value: quantiles}
          - {name: age_buckets, value: "4"}
      - uuid: by-segment
        control-id: R.2
        props:
          - {name: metric_key, value: group_min_positive_rate}
          - {name: "input:dimension", value: c_mktsegment}
"""


@registered("""WITH c AS (SELECT CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS target, c_acctbal, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey),
e AS (SELECT quantile_cont(c_acctbal, [0, 0.25, 0.5, 0.75, 1]) AS e FROM c),
b AS (SELECT CASE WHEN c_acctbal <= e[2] THEN 1 WHEN c_acctbal <= e[3] THEN 2 WHEN c_acctbal <= e[4] THEN 3 ELSE 4 END AS grp, avg(target) AS r FROM c, e GROUP BY 1),
s AS (SELECT c_mktsegment, avg(target) AS r FROM c GROUP BY 1)
SELECT 'by-balance' AS requirement_id, round(min(r), 6) AS actual_value, count(*) AS n_groups, 0.1::DOUBLE AS threshold, min(r) >= 0.1 AS passed FROM b
UNION ALL SELECT 'by-segment', round(min(r), 6), count(*), 0.0, min(r) >= 0 FROM s""")
def bucketed_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Group-rate controls of a policy: one over quartiles of a number, one over names and without a limit."""
    rows = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(F.col("o_totalprice") > 200000, 1).otherwise(0).alias("target"), "c_acctbal", "c_mktsegment")
    run = enforce(rows, resolve(raw_texts(spark, {"rates": BUCKETS})), target="target", balance="c_acctbal")
    groups = run.least_rates.groupBy("requirement_id").agg(F.count(F.lit(1)).alias("n_groups"))
    return rounded(run.results.join(groups, "requirement_id").select("requirement_id", "actual_value", "n_groups", "threshold", "passed"))


@registered(f"""WITH {A}, m AS (SELECT 'accuracy_score' AS metric_key, 'performance' AS category, 'rows' AS scope, 1.0::DOUBLE AS ideal, avg(CASE WHEN target = prediction THEN 1.0 ELSE 0.0 END) AS v FROM a
UNION ALL SELECT 'precision_score', 'performance', 'rows', 1.0, count(*) FILTER (target = 1 AND prediction = 1) / nullif(count(*) FILTER (prediction = 1), 0) FROM a
UNION ALL SELECT 'recall_score', 'performance', 'rows', 1.0, count(*) FILTER (target = 1 AND prediction = 1) / nullif(count(*) FILTER (target = 1), 0) FROM a
UNION ALL SELECT 'f1_score', 'performance', 'rows', 1.0, 2 * count(*) FILTER (target = 1 AND prediction = 1) / nullif(count(*) FILTER (target = 1) + count(*) FILTER (prediction = 1), 0) FROM a)
SELECT metric_key, category, scope, ideal, round(v, 6) AS actual_value, round(ideal - v, 6) AS from_ideal FROM m""")
def metric_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry as a table, joined with what an audit gives for its performance metrics."""
    known = metric_catalogue(spark, "^(accuracy|precision|recall|f1)_score$")
    keys = ("accuracy_score", "precision_score", "recall_score", "f1_score")
    results = enforce(decisions(spark, folder), [Control(k, k, ">", 0.0) for k in keys], target="target", prediction="prediction").results
    joined = known.join(results.select("metric_key", "actual_value"), "metric_key")
    return rounded(joined.select("metric_key", "category", "scope", "ideal", "actual_value", (F.col("ideal") - F.col("actual_value")).alias("from_ideal")))


@registered("""SELECT 'urgent' AS control_id, round(avg(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END), 6) AS actual_value,
  avg(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END) < 0.2 AS passed FROM orders""")
def user_check(spark: SparkSession, folder: str) -> DataFrame:
    """A check of one's own, registered under a key and evaluated with the rest of an audit."""
    @scalar_metric("open_urgent_share")
    def open_urgent_share(control, bound):
        return F.avg(((F.col(bound.require(control.target_role, "target")) == "1-URGENT") & (F.col("o_orderstatus") == "O")).cast("double"))

    try:
        control = Control("urgent", "open_urgent_share", "<", 0.2, target_role="o_orderpriority")
        return rounded(enforce(table(spark, folder, "orders"), [control]).results.select("control_id", "actual_value", "passed"))
    finally:
        del SCALAR_METRICS["open_urgent_share"]


@registered("""SELECT c_custkey AS customer, c_acctbal AS balance, 'unknown' AS region, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment
FROM customer WHERE c_custkey % 5 <> 0""")
def prepared_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Columns with generic names get their real ones, a missing column its default, and rows with gaps go."""
    generic = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Attribute1"), F.col("c_acctbal").alias("Attribute2"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("Attribute3"))
    named = frames.rename_by_position(generic, ["customer", "balance", "segment"])
    return frames.drop_missing(frames.ensure_column(named, "region", "unknown"), ["segment"])


@registered(f"""WITH lv AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {i})" for n, i in volumes.LEVEL_INDEX.items())}) t(name, idx)),
x AS (SELECT vec_id % 10 AS patient, 'T' || (1 + vec_id % 12) AS name FROM embeddings UNION ALL SELECT vec_id % 10, 'L' || (1 + vec_id % 7) FROM embeddings)
SELECT patient, array_to_string(list_sort(list(DISTINCT idx)), ',') AS classes FROM x JOIN lv USING (name) GROUP BY patient""")
def classes_of_patients(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted class numbers of all levels that the notes of a patient name."""
    i = F.col("vec_id")
    notes = F.explode(F.array(F.concat(F.lit("vertebra T"), 1 + i % 12), F.concat(F.lit("L"), 1 + i % 7, F.lit(" level"))))
    labels = table(spark, folder, "embeddings").select((i % 10).alias("patient"), notes.alias("label"))
    classes = volumes.annotated_classes(labels, "patient", "label")
    return classes.select("patient", F.array_join(F.col("classes").cast("array<string>"), ",").alias("classes"))


@registered("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows in the order of a key."""
    return sampling.head(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500)


@registered("""SELECT 'stored' AS origin, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'fallback', s_nationkey, count(*) FROM supplier GROUP BY 2""")
def table_or_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A table where its path exists, and another one in the same schema where it does not."""
    fallback = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"))
    path = shared_folder(spark, "perhaps")
    table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation")).write.parquet(path)
    counted = [
        tables.read_or_sample(spark, place, fallback, fallback.schema).groupBy("nation").agg(F.count(F.lit(1)).alias("n")).select(F.lit(origin).alias("origin"), "nation", "n")
        for origin, place in (("stored", path), ("fallback", f"{path}-absent"))]
    return counted[0].union(counted[1])


@registered("""SELECT CAST(c_nationkey AS VARCHAR) AS owner, count(DISTINCT c_mktsegment) AS n_files, count(DISTINCT c_mktsegment) FILTER (c_mktsegment = 'BUILDING') AS n_segmentations
FROM customer GROUP BY 1""")
def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder by owner; a part of the path tells segmentations from scans."""
    path = shared_folder(spark, "scans")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "SEG").otherwise(F.regexp_replace("c_mktsegment", "SEG", "_"))
    rows = table(spark, folder, "customer").select(F.col("c_nationkey").alias("owner"), kind.alias("kind"), F.col("c_name").alias("value"))
    rows.repartition("owner", "kind").write.partitionBy("owner", "kind").text(path)
    files = tables.list_files(spark, path, "*.txt", r"owner=(\d+)/")
    return files.filter("length > 0").groupBy("owner").agg(F.count(F.lit(1)).alias("n_files"), F.count_if("is_segmentation").alias("n_segmentations"))
