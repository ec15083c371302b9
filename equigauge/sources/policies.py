"""Policy documents: YAML files in six shapes to a flat table of controls."""

from __future__ import annotations

import ast
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge import schemas
from equigauge.functions.judge import as_list
from equigauge.sources import documents

# Executors need not have this package: the parser travels with its tasks.
cloudpickle.register_pickle_by_value(documents)

_RAW = (
    "policy_id string, kind string, requirement_id string, control_id string, title string, description string, "
    "props map<string,string>, href string, warnings array<string>, shape string"
)


def raw_policies(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per requirement, control or inventory item of all documents under the paths; one job for a folder.

    A policy's id is the path of its document without the extension, so documents of one name stay apart.
    """
    texts = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    path = F.regexp_replace(F.input_file_name(), "^file:/+", "/")
    named = texts.select("value", F.regexp_replace(path, r"(?:\.oscal)?\.ya?ml$", "").alias("policy_id"))
    return named.mapInPandas(documents.parse_batches, _RAW)


def raw_texts(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """The same for documents the caller holds, as a map from policy id to text."""
    named = spark.createDataFrame([(text, name) for name, text in texts.items()], "value string, policy_id string")
    return named.mapInPandas(documents.parse_batches, _RAW)


def resolve(raw: DataFrame) -> DataFrame:
    """The controls table: requirements with the props of the items they link to; their own props win."""
    items = raw.filter("kind = 'item'").select(
        "policy_id", F.concat(F.lit("#"), "requirement_id").alias("href"), F.col("props").alias("item_props"),
        F.col("description").alias("item_text"), F.col("warnings").alias("item_warnings"),
    )
    joined = raw.filter("kind = 'requirement'").join(items, ["policy_id", "href"], "left")
    empty = F.create_map().cast("map<string,string>")
    none = F.array().cast("array<string>")
    own = F.col("props")
    inherited = F.map_filter(F.coalesce("item_props", empty), lambda k, v: ~F.map_contains_key(own, k))
    merged = joined.select(
        "policy_id", "requirement_id", "control_id", "title", F.coalesce("description", "item_text").alias("description"),
        F.map_concat(own, inherited).alias("props"),
        F.concat(F.coalesce("warnings", none), F.coalesce("item_warnings", none), F.when(
            F.col("href").isNotNull() & F.col("item_props").isNull(),
            F.array(F.concat(F.lit("unresolved_link:"), "href")),
        ).otherwise(none)).alias("warnings"), "shape",
    )
    return controls_from_props(merged)


def controls_from_props(rows: DataFrame) -> DataFrame:
    """Typed control columns out of the props map. `input:x` and plain `x` are the same input."""

    def prop(*names: str) -> Column:
        return F.coalesce(*[F.try_element_at("props", F.lit(n)) for n in names], F.lit(None).cast("string"))

    def given(name: str) -> Column:
        return prop(f"input:{name}", name)

    typed = rows.select(
        "policy_id", "requirement_id", "control_id", "title", "description",
        prop("metric_key").alias("metric_key"), prop("operator").alias("operator"),
        prop("threshold").try_cast("double").alias("threshold"),
        F.coalesce(prop("severity"), F.lit("medium")).alias("severity"), prop("article").alias("article"),
        given("target").alias("target_role"), given("prediction").alias("prediction_role"),
        given("dimension").alias("dimension"),
        as_list(given("quasi_identifiers")).alias("quasi_identifiers"),
        given("sensitive_attribute").alias("sensitive_attribute"),
        as_list(given("sensitive_columns")).alias("sensitive_columns"),
        F.coalesce(given("aggregation"), given("strategy")).alias("aggregation"),
        given("average").alias("average"),
        prop("age_bucket_method", "bucket_method").alias("bucket_method"),
        prop("age_buckets", "buckets").try_cast("int").alias("buckets"),
        "props", "warnings", "shape",
    )
    # A control that names no metric must not vanish: it stays, with the reason, and cannot be evaluated.
    known = F.coalesce("warnings", F.array().cast("array<string>"))
    dangling = F.exists(known, lambda w: w.startswith("unresolved_link:"))
    unnamed = F.when(F.col("metric_key").isNull() & ~dangling, F.array(F.lit("no_metric_key"))).otherwise(F.array().cast("array<string>"))
    return typed.withColumn("warnings", F.concat(known, unnamed)).to(schemas.CONTROLS)


def read_policies(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Controls of one policy, a list of policies or a folder of them."""
    return resolve(raw_policies(spark, paths))


@dataclass(frozen=True)
class Control:
    """One control on the driver, where it shapes the aggregates of an audit."""

    control_id: str
    metric_key: str
    operator: str
    threshold: float
    requirement_id: str = ""
    policy_id: str = "inline"
    title: str | None = None
    description: str | None = None
    severity: str = "medium"
    article: str | None = None
    target_role: str | None = None
    prediction_role: str | None = None
    dimension: str | None = None
    quasi_identifiers: tuple[str, ...] = ()
    sensitive_attribute: str | None = None
    sensitive_columns: tuple[str, ...] = ()
    aggregation: str | None = None
    average: str | None = None
    bucket_method: str | None = None
    buckets: int = 3
    required_columns: tuple[str, ...] = ()
    warnings: tuple[str, ...] = field(default=(), compare=False)

    @property
    def key(self) -> str:
        return self.requirement_id or self.control_id

    @property
    def about_predictions(self) -> bool:
        from equigauge.plans.enforce import needs_prediction

        return needs_prediction(self)


def as_controls(table: DataFrame) -> list[Control]:
    """Controls on the driver. Their number is that of the hand-written requirements, not of any data."""
    out = []
    for r in table.orderBy("policy_id", "requirement_id").collect():
        props = r["props"] or {}
        required = props.get("input:required_columns") or props.get("required_columns") or ""
        out.append(Control(
            control_id=r["control_id"] or r["requirement_id"], metric_key=r["metric_key"] or "", operator=r["operator"],
            threshold=r["threshold"], requirement_id=r["requirement_id"] or "", policy_id=r["policy_id"] or "inline",
            title=r["title"], description=r["description"] or r["title"], severity=r["severity"], article=r["article"],
            target_role=r["target_role"], prediction_role=r["prediction_role"], dimension=r["dimension"],
            quasi_identifiers=tuple(r["quasi_identifiers"] or ()), sensitive_attribute=r["sensitive_attribute"],
            sensitive_columns=tuple(r["sensitive_columns"] or ()), aggregation=r["aggregation"], average=r["average"],
            bucket_method=r["bucket_method"], buckets=r["buckets"] or 3, required_columns=tuple(_listed(required)),
            warnings=tuple(r["warnings"] or ()),
        ))
    return out


def _listed(text: str) -> list[str]:
    if text.strip().startswith("["):
        return [str(x) for x in ast.literal_eval(text)]
    return [part.strip() for part in text.split(",") if part.strip()]


def load_controls(spark: SparkSession, paths: str | Sequence[str]) -> list[Control]:
    return as_controls(read_policies(spark, paths))
