"""The six document shapes, and audits driven by them."""

import pytest
from pyspark.sql import functions as F

from equigauge.operators.metrics import METRICS
from equigauge.plans import report
from equigauge.plans.enforce import NotEvaluable, PolicyViolation, enforce, enforce_metrics, gate, scalar_metric, SCALAR_METRICS
from equigauge.sources.policies import Control, load_controls, read_policies

PROPS = """
        - {{name: metric_key, value: {key}}}
        - {{name: threshold, value: "0.2"}}
        - {{name: operator, value: "<"}}"""

S1 = """
system-security-plan:
  control-implementation:
    implemented-requirements:
      - uuid: r1
        control-id: c1
        props:
        - {name: metric_key, value: class_imbalance}
        - {name: threshold, value: "0.4"}
        - {name: operator, value: gt}
        - {name: quasi_identifiers, value: "age, gender"}
"""
S2 = """
assessment-plan:
  control-implementations:
    - description: x
      implemented-requirements:
        - control-id: c2
          description: no uuid here
          props:
            - {name: metric_key, value: disparate_impact}
            - {name: threshold, value: "0.8"}
            - {name: operator, value: gt}
            - {name: "input:dimension", value: gender}
        - control-id: c2
          props:
            - {name: metric_key, value: disparate_impact}
            - {name: threshold, value: "0.5"}
            - {name: operator, value: gt}
            - {name: "input:dimension", value: age}
"""
S3 = """
assessment-plan:
  reviewed-controls:
    control-selections:
      - include-controls:
        - control-id: c3
          props:
            - {name: metric_key, value: disparate_impact_ratio}
            - {name: "input:dimension", value: age}
            - {name: operator, value: ">"}
            - {name: threshold, value: "0.5"}
"""
S4 = """
assessment-plan:
  reviewed-controls:
    control-implementations:
      - implemented-requirements:
          - control-id: c4
            props:
              - {name: severity, value: critical}
              - {name: metric_key, value: global_dice}
              - {name: threshold, value: "0.85"}
              - {name: operator, value: gt}
              - {name: article, value: "15"}
"""
S5 = """
catalog:
  controls:
    - {id: A.1, title: t}
  inventory-items:
    - uuid: m1
      description: from the item
      props:
        - {name: metric_key, value: k_anonymity}
        - {name: threshold, value: "5"}
        - {name: operator, value: ">="}
        - {name: "input:quasi_identifiers", value: "['age', 'job']"}
        - {name: severity, value: low}
  control-implementations:
    - implemented-requirements:
        - uuid: outer
          control-id: A.1
          implemented-requirements:
            - uuid: inner-1
              control-id: A.1
              props: [{name: severity, value: high}]
              links: [{href: "#m1"}]
            - uuid: inner-2
              control-id: A.1
              links: [{href: "#m1"}]
            - uuid: dangling
              control-id: A.1
              props: [{name: metric_key, value: l_diversity}]
              links: [{href: "#nowhere"}]
"""
S6 = """
catalog:
  controls:
    - id: top
      controls:
        - id: c6
          title: only a title
          props:
            - {name: metric_key, value: predictive_equality_diff}
            - {name: operator, value: "<"}
            - {name: threshold, value: "0.10"}
            - {name: operator, value: ">"}
"""
EMPTY = "system-security-plan:\n  control-implementation:\n    implemented-requirements: []\n"


@pytest.fixture
def folder(tmp_path):
    for name, text in dict(s1=S1, s2=S2, s3=S3, s4=S4, s5=S5, s6=S6, empty=EMPTY).items():
        (tmp_path / f"{name}.oscal.yaml").write_text(text)
    return tmp_path


def test_all_shapes_in_one_scan(spark, folder):
    rows = {(r["policy_id"].rsplit("/", 1)[-1], r["requirement_id"]): r for r in read_policies(spark, str(folder)).collect()}
    assert sorted(k[0] for k in rows) == ["s1", "s2", "s2", "s3", "s4", "s5", "s5", "s5", "s6"]
    assert rows[("s1", "r1")]["quasi_identifiers"] == ["age", "gender"]
    assert len({k for k in rows if k[0] == "s2"}) == 2
    assert rows[("s5", "inner-1")]["severity"] == "high" and rows[("s5", "inner-2")]["severity"] == "low"
    assert rows[("s5", "inner-1")]["threshold"] == 5.0 and rows[("s5", "inner-1")]["description"] == "from the item"
    assert rows[("s5", "inner-1")]["quasi_identifiers"] == ["age", "job"]
    assert rows[("s5", "dangling")]["warnings"] == ["unresolved_link:#nowhere"]
    s6 = next(r for k, r in rows.items() if k[0] == "s6")
    assert s6["operator"] == ">" and s6["warnings"] == ["duplicate_prop:operator"]
    s4 = next(r for k, r in rows.items() if k[0] == "s4")
    assert (s4["article"], s4["severity"]) == ("15", "critical")


def test_empty_policy(spark, folder):
    path = str(folder / "empty.oscal.yaml")
    df = spark.createDataFrame([(1,)], "target int")
    run = enforce(df, path, target="target")
    assert run.results.count() == 0
    assert report.summary(run.results).first()["overall_pass"] is True


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i % 2, (i // 2) % 2, "mf"[i % 3 == 0], 20 + i % 40, "c1" if i % 5 else None) for i in range(120)]
    return spark.createDataFrame(rows, "y int, p int, Attribute9 string, Attribute13 int, job string")


def test_roles_and_several_policies(spark, folder, table):
    paths = [str(folder / "s2.oscal.yaml"), str(folder / "s3.oscal.yaml"), str(folder / "s1.oscal.yaml")]
    run = enforce(table, paths, target="y", gender="Attribute9", age="Attribute13")
    got = run.results.collect()
    assert len(got) == 4 and all(r["evaluated"] for r in got)
    assert {r["dimension"] for r in got} == {"gender", "age", None}
    assert run.rates.select("grp").distinct().count() == 2 + 40


def test_strict_mode_and_gate(spark, folder, table):
    path = str(folder / "s5.oscal.yaml")
    with pytest.raises(NotEvaluable):
        enforce(table, path, target="y", strict=True)
    results = enforce(table, path, target="y", age="Attribute13").results
    by_id = {r["requirement_id"]: r for r in results.collect()}
    assert by_id["inner-1"]["evaluated"] and not by_id["dangling"]["evaluated"] and not by_id["dangling"]["passed"]
    with pytest.raises(PolicyViolation, match=f"{results.filter('NOT passed').count()} failed"):
        gate(results)
    gate(results.filter("passed"))


def test_task_keys(spark):
    df = spark.createDataFrame([(1, 1, 2, 0), (0, 1, 2, 2), (1, 1, 0, 0)], (
        "target_gender int, prediction_gender int, target_race int, prediction_race int"
    ))
    controls = [
        Control("g", "accuracy_score_gender", ">", 0.5), Control("r", "recall_score_race", ">", 0.5, average="macro"),
    ]
    got = {r["control_id"]: r["actual_value"] for r in enforce(df, controls).results.collect()}
    assert got["g"] == pytest.approx(2 / 3) and got["r"] == pytest.approx(0.75)


def test_group_rate_control_carries_its_groups(spark, table):
    controls = [
        Control("g", "group_min_positive_rate", "gt", 0.5, dimension="gender"),
        Control("a", "group_min_positive_rate", "gt", 0.25, dimension="age", bucket_method="quantiles", buckets=3),
        Control("x", "group_min_positive_rate", "gt", 0.25, dimension="absent"),
    ]
    run = enforce(table, controls, target="y", gender="Attribute9", age="Attribute13")
    got = {r["control_id"]: r for r in run.results.collect()}
    rates = {(r["requirement_id"], r["grp"]) for r in run.least_rates.collect()}
    assert {g for k, g in rates if k == "g"} == {"m", "f"} and len({g for k, g in rates if k == "a"}) == 3
    assert got["g"]["actual_value"] == 0.5
    assert got["g"]["passed"] and got["g"]["operator"] == "gt"
    assert not got["x"]["passed"] and "absent" in got["x"]["message"]


def test_a_group_rate_without_threshold_is_held_to_zero(spark, table):
    control = Control("g", "group_min_positive_rate", "gt", None, dimension="Attribute9")
    row = enforce(table, [control], target="y").results.first()
    assert row["passed"] and row["evaluated"] and row["threshold"] == 0.0


DANGLING = """
catalog:
  control-implementations:
    - implemented-requirements:
        - {uuid: lost, control-id: L.1, links: [{href: "#nowhere"}]}
        - {uuid: odd, control-id: L.2, props: [{name: metric_key, value: no_such_metric}, {name: operator, value: "<"}, {name: threshold, value: "1"}]}
"""


def test_a_control_never_vanishes(spark, tmp_path, table):
    (tmp_path / "gaps.oscal.yaml").write_text(DANGLING)
    got = {r["requirement_id"]: r for r in enforce(table, str(tmp_path), target="y").results.collect()}
    assert set(got) == {"lost", "odd"} and not any(r["evaluated"] or r["passed"] for r in got.values())
    assert got["lost"]["message"] == "unresolved_link:#nowhere"
    for kept in ("lost", "odd"):
        controls = [c for c in load_controls(spark, str(tmp_path)) if c.key == kept]
        with pytest.raises(NotEvaluable):
            enforce(table, controls, target="y", strict=True)
    metrics = spark.createDataFrame([("a", 1.0)], "metric_key string, value double")
    assert enforce_metrics(metrics, str(tmp_path)).filter("NOT evaluated AND NOT passed").count() == 2


@pytest.mark.parametrize(("entry", "reason"), [
    ("{uuid: x, control-id: X, props: [{name: metric-key, value: accuracy_score}]}", "no_metric_key"),
    ("{uuid: x, control-id: X, props: [{name: operator, value: '>'}, {name: threshold, value: '1'}]}", "no_metric_key"),
    ("{uuid: x, control-id: X, props: [{name: severity, value: high}]}", "no_metric_key"),
    ("{uuid: x, control-id: X, links: [{href: '#i'}]}", "no_metric_key"),
    ("{uuid: x, control-id: X, props: [{name: metric_key, value: class_imbalance}, {name: operator, value: '>'}, {name: threshold, value: much}]}", "no threshold is given"),
    ("{uuid: x, control-id: X, props: [{name: metric_key, value: class_imbalance}, {name: threshold, value: '1'}]}", "no operator is given"),
    ("{uuid: x, control-id: X, props: [{name: metric_key, value: class_imbalance}, {name: operator, value: near}, {name: threshold, value: '1'}]}", "unknown operator 'near'"),
])
def test_a_control_that_says_too_little_is_kept_and_refused_by_strict_mode(spark, tmp_path, table, entry, reason):
    (tmp_path / "p.oscal.yaml").write_text(
        "catalog:\n  inventory-items: [{uuid: i, props: [{name: severity, value: low}]}]\n  control-implementations:\n"
        "    - implemented-requirements:\n        - {uuid: group, control-id: G, props: [{name: severity, value: low}], implemented-requirements: [" + entry + "]}\n")
    rows = enforce(table, str(tmp_path), target="y").results.collect()
    assert [(r["requirement_id"], r["evaluated"], r["passed"], r["message"]) for r in rows] == [("x", False, False, reason)]
    with pytest.raises(NotEvaluable, match=reason):
        enforce(table, str(tmp_path), target="y", strict=True)


def test_catalogue_entries_without_a_measure_are_no_controls(spark, tmp_path):
    (tmp_path / "p.oscal.yaml").write_text("catalog: {controls: [{id: a, title: t, props: [{name: label, value: A}]}, {id: b, props: [{name: threshold, value: '1'}]}]}")
    assert [r["control_id"] for r in read_policies(spark, str(tmp_path)).collect()] == ["b"]


def test_policies_of_one_name_stay_apart(spark, tmp_path):
    for k, limit in enumerate(("0.1", "0.9")):
        place = tmp_path / f"p{k}" / "data_policy.oscal.yaml"
        place.parent.mkdir()
        place.write_text(S5.replace('value: "5"', f'value: "{limit}"'))
    rows = read_policies(spark, [str(tmp_path / "p0"), str(tmp_path / "p1")]).filter("requirement_id = 'inner-1'").collect()
    assert sorted((r["policy_id"].split("/")[-2], r["threshold"]) for r in rows) == [("p0", 0.1), ("p1", 0.9)]


def test_metrics_are_judged_by_dimension(spark):
    metrics = spark.createDataFrame([("k", "race", 0.1), ("k", "sex", 0.9), ("k", None, 0.5), ("t", None, 1.0), ("t", None, 2.0)], "metric_key string, dimension string, value double")
    controls = [Control("r", "k", "<", 0.3, dimension="race"), Control("s", "k", "<", 0.3, dimension="sex"), Control("n", "k", "<", 0.3),
                Control("a", "k", "<", 0.3, dimension="age"), Control("t", "t", "<", 9.0)]
    got = {r["control_id"]: (r["actual_value"], r["passed"], r["evaluated"]) for r in enforce_metrics(metrics, controls).collect()}
    assert got["r"] == (0.1, True, True) and got["s"] == (0.9, False, True) and got["n"] == (0.5, False, True)
    assert got["a"] == (None, False, False) and not got["t"][1] and not got["t"][2]


def test_two_controls_of_one_metric_stay_apart(spark, table):
    controls = [Control("a", "disparate_impact", "gt", 0.1, requirement_id="1", dimension="Attribute9"),
                Control("a", "disparate_impact", "gt", 0.9999, requirement_id="2", dimension="Attribute13")]
    assert enforce(table, controls, target="y").results.count() == 2


def test_user_metric_runs_with_the_rest(spark, table):
    @scalar_metric("null_share")
    def null_share(control, bound):
        return F.avg(F.col(bound.require(control.target_role, "target")).isNull().cast("double"))

    try:
        controls = [Control("n", "null_share", "<", 0.3, target_role="job"), Control("d", "data_minimization", ">", 0.5, sensitive_columns=("job",))]
        got = {r["control_id"]: r["actual_value"] for r in enforce(table, controls, target="y").results.collect()}
        assert got == {"n": pytest.approx(0.2), "d": pytest.approx(0.8)}
    finally:
        del SCALAR_METRICS["null_share"]


def test_precomputed_metrics(spark, folder):
    metrics = spark.createDataFrame([("global_dice", 0.9)], "metric_key string, value double")
    row = enforce_metrics(metrics, str(folder / "s4.oscal.yaml")).first()
    assert row["passed"] and row["message"] == "0.9000 > 0.8500"
    with pytest.raises(NotEvaluable):
        enforce_metrics(metrics, [Control("x", "other", "<", 1.0)], strict=True)


def test_known_metrics_have_categories():
    assert {m.category for m in METRICS.values()} == {"fairness", "performance", "quality"}


def test_load_controls_order_is_stable(spark, folder):
    assert [c.key for c in load_controls(spark, str(folder))] == [c.key for c in load_controls(spark, str(folder))]
