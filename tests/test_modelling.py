"""Encoding, training and audited scoring."""

import pytest
from pyspark.ml import Pipeline

from equigauge.operators.frames import one_hot
from equigauge.operators.modelling import AuditedModel, feature_stages
from equigauge.sources.policies import Control


@pytest.fixture(scope="module")
def loans(spark):
    rows = [(i, float(i % 50), "abc"[i % 3], int(i % 50 > 20), "mf"[i % 2]) for i in range(400)]
    return spark.createDataFrame(rows, "id int, amount double, job string, target int, gender string")


def test_first_level_is_dropped(spark, loans):
    coded = Pipeline(stages=feature_stages([], ["job"], drop_first=True)).fit(loans).transform(loans)
    got = {r["job"]: list(r["features"].toArray()) for r in coded.select("job", "features").distinct().collect()}
    assert got["a"] == [0.0, 0.0] and sorted([got["b"], got["c"]]) == [[0.0, 1.0], [1.0, 0.0]]
    dummies = one_hot(loans.select("id", "job"), ["job"], drop_first=True)
    assert dummies.columns == ["id", "job_b", "job_c"]
    assert dummies.filter("id = 0").first()[1:] == (0, 0)


def test_unseen_level_has_its_own_column(spark, loans):
    fitted = Pipeline(stages=feature_stages([], ["job"])).fit(loans.filter("job <> 'c'"))
    got = {r["job"]: list(r["features"].toArray()) for r in fitted.transform(loans).select("job", "features").distinct().collect()}
    assert got["c"] == [0.0, 0.0, 1.0]


def test_named_levels(spark, loans):
    coded = one_hot(loans.select("id", "job"), ["job"], levels={"job": ["c", "z"]})
    assert coded.columns == ["id", "job_c", "job_z"] and coded.filter("id = 2").first()[1:] == (1, 0)


def test_audited_scoring(spark, loans):
    controls = [
        Control("balance", "class_imbalance", "gt", 0.2), Control("acc", "accuracy_score", ">", 0.9),
        Control("dp", "demographic_parity_diff", "<", 0.5, dimension="gender"),
    ]
    model = AuditedModel(controls, {"gender": "gender"}, "target", ["amount"], ["job"]).fit(loans)
    pre = model.data_audit.results.collect()
    assert [(r["control_id"], r["phase"]) for r in pre] == [("balance", "pre"), ("dp", "pre")]
    scored = model.predict(loans)
    assert set(scored.columns) == {*loans.columns, "prediction"}
    post = {r["control_id"]: r for r in model.last_audit.results.collect()}
    assert all(r["passed"] and r["phase"] == "post" for r in post.values())
    scored.count()
    assert model.observed.get["n_rows"] == 400
    assert model.observed.get["accuracy"] == pytest.approx(post["acc"]["actual_value"])
    with pytest.raises(RuntimeError):
        AuditedModel(controls, {}, "target", ["amount"]).predict(loans)
