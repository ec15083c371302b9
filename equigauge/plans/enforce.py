"""Judging a table, or precomputed metrics, by the controls of a policy.

Controls are sorted by what they need. All count-based metrics share one pass over the table, all single aggregates
share another; each privacy measure and each group-rate check has a grouping of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge import schemas
from equigauge.functions.judge import OPERATORS, compare, message
from equigauge.functions.ratios import ratio
from equigauge.operators.components import Lens, class_counts, group_rates, lens_components
from equigauge.operators.metrics import METRICS, Metric, find_metric, metric_value
from equigauge.operators.privacy import data_minimization, k_anonymity, l_diversity, t_closeness
from equigauge.operators.quality import _filled, group_positive_rates, smallest_positive_rate
from equigauge.sources.policies import Control, as_controls, load_controls

_VALUES = "idx int, value double, n_rows bigint, groups map<string,double>"


class PolicyViolation(Exception):
    """A control failed and the gate is closed."""


class NotEvaluable(Exception):
    """Strict mode: a control cannot be evaluated on this table."""


@dataclass
class Binding:
    """Which physical columns the roles of one audit stand for."""

    df: DataFrame
    target: str | None
    prediction: str | None
    roles: dict[str, str]
    positive: object

    def column(self, role: str | None) -> str | None:
        if role is None:
            return None
        if role == "target" and self.target:
            return self.target
        if role == "prediction" and self.prediction:
            return self.prediction
        return self.roles.get(role, role)

    def require(self, role: str | None, what: str) -> str:
        name = self.column(role)
        if name is None:
            raise LookupError(f"no {what} is bound")
        if name not in self.df.columns:
            raise LookupError(f"{what} column '{name}' is not in the table")
        return name

    def protected(self) -> list[str]:
        return [c for c in self.roles.values() if c in self.df.columns]


@dataclass
class AuditRun:
    """Results of an audit.

    `rates` has the confusion rates of every group that took part, one row each. `least_rates` has the positive rates of
    every group of the group-rate controls: requirement_id, grp, n, positive_rate.
    """

    results: DataFrame
    rates: DataFrame | None
    controls: list[Control]
    least_rates: DataFrame | None = None


FrameMetric = Callable[[Control, Binding], DataFrame]
ScalarMetric = Callable[[Control, Binding], Column]
FRAME_METRICS: dict[str, FrameMetric] = {}
SCALAR_METRICS: dict[str, ScalarMetric] = {}


def frame_metric(key: str) -> Callable[[FrameMetric], FrameMetric]:
    """Register a metric that builds its own one-row frame (value, n_rows, groups)."""

    def add(fn: FrameMetric) -> FrameMetric:
        FRAME_METRICS[key] = fn
        return fn

    return add


def scalar_metric(key: str) -> Callable[[ScalarMetric], ScalarMetric]:
    """Register a metric that is a single aggregate; all of them are taken in one pass."""

    def add(fn: ScalarMetric) -> ScalarMetric:
        SCALAR_METRICS[key] = fn
        return fn

    return add


def _row(value: Column, n_rows: Column) -> list[Column]:
    return [
        value.cast("double").alias("value"), n_rows.cast("bigint").alias("n_rows"),
        F.lit(None).cast("map<string,double>").alias("groups"),
    ]


@scalar_metric("column_mean")
def _column_mean(control: Control, bound: Binding) -> Column:
    c = F.col(bound.require(control.target_role or "target", "target")).cast("double")
    return F.avg(F.when(~F.isnan(c), c))


@scalar_metric("data_completeness")
def _data_completeness(control: Control, bound: Binding) -> Column:
    required = list(control.required_columns) or list(dict.fromkeys([*filter(None, [bound.target]), *bound.protected()]))
    if not required:
        raise LookupError("no required columns are named or bound")
    present = [bound.column(c) for c in required if bound.column(c) in bound.df.columns]
    filled = sum((F.count_if(_filled(bound.df, c)) for c in present), F.lit(0))
    return ratio(filled, F.count(F.lit(1)) * len(required))


def _keys(control: Control, bound: Binding) -> list[str]:
    if not control.quasi_identifiers:
        raise LookupError("no quasi-identifiers are named")
    return [bound.require(q, "quasi-identifier") for q in control.quasi_identifiers]


@frame_metric("k_anonymity")
def _k(control: Control, bound: Binding) -> DataFrame:
    return k_anonymity(bound.df, _keys(control, bound)).select(*_row(F.col("k"), F.col("n_rows")))


@frame_metric("l_diversity")
def _l(control: Control, bound: Binding) -> DataFrame:
    sensitive = bound.require(control.sensitive_attribute, "sensitive attribute")
    return l_diversity(bound.df, _keys(control, bound), sensitive).select(*_row(F.col("l"), F.col("n_rows")))


@frame_metric("t_closeness")
def _t(control: Control, bound: Binding) -> DataFrame:
    sensitive = bound.require(control.sensitive_attribute, "sensitive attribute")
    one = t_closeness(bound.df, _keys(control, bound), sensitive, control.aggregation == "ordered")
    return one.select(*_row(F.col("t"), F.col("n_rows")))


@frame_metric("data_minimization")
def _minimal(control: Control, bound: Binding) -> DataFrame:
    sensitive = [bound.column(c) for c in control.sensitive_columns] or bound.protected()
    value = data_minimization(bound.df, sensitive)
    return bound.df.sparkSession.range(1).select(*_row(F.lit(value), F.lit(None)))


@frame_metric("group_min_positive_rate")
def _least_rate(control: Control, bound: Binding) -> DataFrame:
    return smallest_positive_rate(_control_rates(control, bound)).select(*_row(F.col("value"), F.col("n_rows")))


def _control_rates(control: Control, bound: Binding) -> DataFrame:
    target = bound.require(control.target_role or "target", "target")
    dimension = bound.require(control.dimension, "dimension")
    return group_positive_rates(bound.df, target, dimension, control.bucket_method, control.buckets)


def task_of(key: str) -> tuple[Metric | None, str | None]:
    """The metric of a key, and the task a suffix such as `_gender` names."""
    metric = find_metric(key)
    if metric is not None:
        return metric, None
    for base in sorted(METRICS, key=len, reverse=True):
        if key.startswith(f"{base}_"):
            return METRICS[base], key[len(base) + 1:]
    return None, None


def needs_prediction(control: Control) -> bool:
    if control.metric_key in FRAME_METRICS or control.metric_key in SCALAR_METRICS:
        return control.prediction_role is not None
    metric, task = task_of(control.metric_key)
    return metric is not None and (metric.needs_prediction or task is not None or control.prediction_role is not None)


def _lens(control: Control, metric: Metric, task: str | None, bound: Binding) -> Lens:
    if task is not None:
        target = bound.require(f"target_{task}", "target")
        prediction = bound.require(f"prediction_{task}", "prediction")
    else:
        target = bound.require(control.target_role or "target", "target")
        if control.prediction_role:
            prediction = bound.require(control.prediction_role, "prediction")
        elif metric.needs_prediction:
            prediction = bound.require("prediction" if bound.prediction else None, "prediction")
        else:
            about_data = control.target_role is not None or metric.category == "quality"
            prediction = None if about_data else bound.prediction
    dimension: tuple[str, ...] = ()
    if metric.scope == "groups":
        role = control.dimension or ("dimension" if "dimension" in bound.roles else None)
        parts = [p.strip() for p in (role or "").split("+") if p.strip()]
        if not parts:
            raise LookupError("no dimension is named")
        dimension = tuple(bound.require(p, "dimension") for p in parts)
    name = "|".join([target, prediction or "", *dimension])
    return Lens(name, target, prediction, dimension, str(bound.positive))


def enforce(
    df: DataFrame, policy: object, *, target: str | None = None, prediction: str | None = None,
    positive: object = 1, strict: bool = False, phase: str | None = None, **roles: str,
) -> AuditRun:
    """Evaluate a policy on a table. `policy` is a path, several paths, a controls table or a list of controls.

    Further keywords bind roles to columns (`age="Attribute13"`). A control that cannot be evaluated gives a failed
    row with `evaluated = false`, or an error in strict mode.
    """
    spark = df.sparkSession
    controls = to_controls(spark, policy)
    bound = Binding(df, target, prediction, dict(roles), positive)

    lenses: dict[str, Lens] = {}
    counted: list[tuple[int, str, Column]] = []
    scalars: list[tuple[int, Column]] = []
    frames: list[DataFrame] = []
    problems: dict[int, str] = {}
    least: list[DataFrame] = []
    for i, control in enumerate(controls):
        try:
            if not control.metric_key:
                raise LookupError(without_metric(control))
            if control.metric_key != "group_min_positive_rate":
                without_limit(control)
            if control.metric_key in FRAME_METRICS:
                one = FRAME_METRICS[control.metric_key](control, bound)
                if control.metric_key == "group_min_positive_rate":
                    least.append(_control_rates(control, bound).select(
                        F.lit(control.key).alias("requirement_id"), "grp", "n", "positive_rate"))
                frames.append(one.select(F.lit(i).alias("idx"), "value", "n_rows", "groups"))
            elif control.metric_key in SCALAR_METRICS:
                scalars.append((i, SCALAR_METRICS[control.metric_key](control, bound)))
            else:
                metric, task = task_of(control.metric_key)
                if metric is None:
                    raise LookupError(f"unknown metric '{control.metric_key}'")
                lens = _lens(control, metric, task, bound)
                lenses[lens.name] = lens
                counted.append((i, lens.name, metric_value(metric, control.aggregation or control.average)))
        except (LookupError, ValueError) as error:
            problems[i] = str(error).strip('"')
    if strict and problems:
        raise NotEvaluable("; ".join(f"{controls[i].key}: {why}" for i, why in problems.items()))

    rates = None
    if counted:
        counts = class_counts(df, list(lenses.values()))
        entries = [
            F.struct(F.lit(name).alias("_lens"), F.lit(i).alias("idx"), value.cast("double").alias("value"))
            for i, name, value in counted
        ]
        wide = lens_components(counts).select("lens", F.col("n").cast("bigint").alias("n_rows"), F.inline(F.array(*entries)))
        none = F.lit(None).cast("map<string,double>").alias("groups")
        frames.append(wide.filter("lens = _lens").select("idx", "value", "n_rows", none))
        rates = group_rates(counts).filter("grp <> ''")
    if scalars:
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[value.cast("double").alias(f"v{i}") for i, value in scalars])
        entries = [F.struct(F.lit(i).alias("idx"), F.col(f"v{i}").alias("value")) for i, _ in scalars]
        frames.append(one.select("n_rows", F.inline(F.array(*entries))).select(
            "idx", "value", "n_rows", F.lit(None).cast("map<string,double>").alias("groups")
        ))
    values = spark.createDataFrame([], _VALUES)
    for frame in frames:
        values = values.unionByName(frame)
    table = control_rows(spark, controls, problems)
    return AuditRun(judge(table.join(values, "idx", "left"), phase), rates, controls, reduce(DataFrame.unionByName, least) if least else None)


def without_metric(control: Control) -> str:
    return "; ".join(control.warnings) or "no metric is named"


def without_limit(control: Control) -> None:
    """Raise if a control cannot be compared with anything."""
    if control.operator not in OPERATORS:
        raise LookupError(f"unknown operator '{control.operator}'" if control.operator else "no operator is given")
    if control.threshold is None:
        raise LookupError("no threshold is given")


def to_controls(spark: SparkSession, policy: object) -> list[Control]:
    if isinstance(policy, DataFrame):
        return as_controls(policy)
    if isinstance(policy, str):
        return load_controls(spark, policy)
    items = list(policy)
    if all(isinstance(p, Control) for p in items):
        return items
    return [c for p in items for c in (to_controls(spark, p) if not isinstance(p, Control) else [p])]


def control_rows(spark: SparkSession, controls: Sequence[Control], problems: dict[int, str]) -> DataFrame:
    """The controls as a local table."""
    rows = [
        (i, c.policy_id, c.key, c.control_id, c.description, c.metric_key, c.dimension, c.operator, c.threshold,
         c.severity, c.article, problems.get(i))
        for i, c in enumerate(controls)
    ]
    return spark.createDataFrame(rows, (
        "idx int, policy_id string, requirement_id string, control_id string, description string, metric_key string, "
        "dimension string, operator string, threshold double, severity string, article string, problem string"
    ))


def judge(rows: DataFrame, phase: str | None) -> DataFrame:
    """Results from controls with their values.

    The group-rate check passes on equality although it reports `gt`, and its threshold is 0 where none is given.
    """
    special = F.col("metric_key") == "group_min_positive_rate"
    rows = rows.withColumn("threshold", F.when(special, F.coalesce("threshold", F.lit(0.0))).otherwise(F.col("threshold")))
    operator = F.when(special, F.lit("gte")).otherwise(F.col("operator"))
    shown = F.when(special, F.lit("gt")).otherwise(F.col("operator"))
    holds = compare(F.col("value"), operator, F.col("threshold"))
    evaluated = F.col("problem").isNull() & holds.isNotNull()
    return rows.select(
        "policy_id", "requirement_id", "control_id", "description", "metric_key", "dimension",
        F.col("value").alias("actual_value"), shown.alias("operator"), "threshold",
        F.coalesce(holds & F.col("problem").isNull(), F.lit(False)).alias("passed"), "severity", "article",
        F.coalesce("problem", message(F.col("value"), operator, F.col("threshold"))).alias("message"),
        F.col("groups").alias("groups"), F.lit(phase).cast("string").alias("phase"), evaluated.alias("evaluated"),
    ).to(schemas.RESULTS)


def enforce_metrics(metrics: DataFrame, policy: object, *, strict: bool = False, phase: str | None = None) -> DataFrame:
    """Evaluate a policy on precomputed (metric_key, value) rows, by dimension too where they have one.

    A control without a value, or whose value is given more than once, is not evaluated; strict mode raises.
    """
    spark = metrics.sparkSession
    controls = to_controls(spark, policy)
    by = F.col("dimension") if "dimension" in metrics.columns else F.lit(None).cast("string")
    given = metrics.filter(F.col("metric_key").isin(*{c.metric_key for c in controls})).groupBy(
        F.col("metric_key").alias("key"), by.cast("string").alias("by")).agg(
        F.count(F.lit(1)).alias("times"), F.max(F.col("value").cast("double")).alias("value"))
    problems = {i: without_metric(c) for i, c in enumerate(controls) if not c.metric_key}
    rows = control_rows(spark, controls, problems)
    same = (F.col("metric_key") == F.col("key")) & (F.col("dimension").eqNullSafe(F.col("by")) if "dimension" in metrics.columns else F.lit(True))
    twice = F.when(F.col("times") > 1, F.lit("the metric is given more than once"))
    joined = rows.join(given, same, "left").withColumns({
        "problem": F.coalesce("problem", twice), "groups": F.lit(None).cast("map<string,double>")})
    results = judge(joined, phase)
    if strict:
        open_ = [r[0] for r in results.filter(~F.col("evaluated")).select("requirement_id").collect()]
        if open_:
            raise NotEvaluable(f"no single value for {', '.join(sorted(open_))}")
    return results


def gate(results: DataFrame) -> None:
    """Raise if a control failed, and name all that did; results have one row per control."""
    failed = results.filter(~F.col("passed")).select("control_id", "message").collect()
    if failed:
        raise PolicyViolation(f"{len(failed)} failed: " + "; ".join(f"{r['control_id']}: {r['message']}" for r in failed))
