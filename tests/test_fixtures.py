"""Hand-made tables with known answers."""

import pytest
from pyspark.sql import functions as F

from equigauge.functions import bins, clean
from equigauge.functions.judge import as_list, compare, risk_band
from equigauge.operators import cohort, volumes
from equigauge.operators.components import Lens, class_counts, confusion_wide, group_rates
from equigauge.operators.metrics import METRICS, Metric, measure, metric_catalogue, register_metric
from equigauge.operators.quality import group_positive_rates, smallest_positive_rate


def frame(spark, rows, schema="target int, pred int, dim string"):
    return spark.createDataFrame(rows, schema)


def value(spark, df, key, variant=None, dims=("dim",), positive="1"):
    lens = Lens("x", "target", "pred", dims, positive)
    return measure(df, [lens], [("x", key, variant)]).first()["value"]


FAIR = ([(0, 0, "A")] * 4 + [(1, 0, "A")] + [(0, 0, "B")] * 4 + [(1, 0, "B")] + [(1, 1, "A"), (1, 1, "B")]) * 5
EXTREME = ([(0, 0, "A")] * 2 + [(1, 0, "B")] * 2 + [(1, 1, "A"), (1, 1, "B")]) * 10
MULTI = (
    [(0, 0, "A")] + [(0, 0, "B")] * 4 + [(1, 0, "B")] + [(1, 1, "A"), (0, 1, "A")] + [(1, 1, "B")] * 9 + [(0, 1, "B")]
) * 3


@pytest.mark.parametrize("rows,greatest,mean", [(FAIR, 0.0, 0.0), (EXTREME, 1.0, 0.5), (MULTI, 0.4, 0.3)])
def test_predictive_parity_by_class(spark, rows, greatest, mean):
    df = frame(spark, rows)
    assert value(spark, df, "predictive_parity", "max") == pytest.approx(greatest)
    assert value(spark, df, "predictive_parity", "mean") == pytest.approx(mean)


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 25.0, 25.5, 45.0, 100.0, 101.0)], "age double")
    got = [r[0] for r in df.select(bins.cut("age", [0, 25, 45, 100], ["Young", "Adult", "Senior"])).collect()]
    assert got == [None, "Young", "Young", "Adult", "Adult", "Senior", None]


def test_age_text(spark):
    df = spark.createDataFrame([("055Y",), ("60",), ("M",), (None,), (" 7Y ",)], "a string")
    assert [r[0] for r in df.select(clean.age_in_years("a")).collect()] == [55, 60, None, None, 7]


def test_vertebra_labels(spark):
    df = spark.createDataFrame([("T1 vertebra",), ("T10",), ("L2 level",), ("rib",), ("the sacrum",)], "t string")
    assert [r[0] for r in df.select(volumes.label_index("t")).collect()] == [34, 25, 21, None, 92]


def test_annotated_classes_are_distinct_and_sorted(spark):
    df = spark.createDataFrame([(1, "T1"), (1, "t1 body"), (1, "L5"), (1, "rib"), (2, "rib")], "p int, t string")
    assert [tuple(r) for r in volumes.annotated_classes(df, "p", "t").collect()] == [(1, [18, 34])]


def test_unknown_groups_and_values_drop_out(spark):
    df = frame(spark, [(1, 1, "A"), (0, 0, "A"), (1, 1, None), (None, 1, "B"), (1, None, "B"), (0, 1, "B")])
    rates = {r["grp"]: r["n"] for r in group_rates(class_counts(df, [Lens("x", "target", "pred", ("dim",))])).collect()}
    assert rates == {"A": 2, "B": 1}


def test_empty_denominators_give_zero(spark):
    df = frame(spark, [(1, 1, "A"), (1, 0, "A"), (0, 0, "B"), (0, 0, "B")])
    rates = {r["grp"]: r for r in group_rates(class_counts(df, [Lens("x", "target", "pred", ("dim",))])).collect()}
    assert rates["A"]["fpr"] == 0.0 and rates["A"]["tnr"] == 0.0
    assert rates["B"]["tpr"] == 0.0 and rates["B"]["precision"] == 0.0


def test_absent_class_counts_as_zero_share(spark):
    df = frame(spark, [(0, 0, "A"), (1, 2, "A"), (0, 0, "B"), (1, 0, "B")])
    assert value(spark, df, "multiclass_demographic_parity") == pytest.approx(0.5)


def test_single_class_and_zero_variance(spark):
    df = frame(spark, [(1, 1, "A"), (1, 1, "B")])
    assert value(spark, df, "demographic_parity_diff") == 0.0
    assert value(spark, df, "class_imbalance", dims=()) == 1.0
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "Confidence double, Dice double")
    from equigauge.functions.ratios import pearson

    assert flat.agg(pearson("Confidence", "Dice")).first()[0] is None


def test_targets_and_predictions_of_different_types_agree(spark):
    df = spark.createDataFrame([(1, 1.0, "A"), (0, 0.0, "A"), (1, 0.0, "B")], "target int, pred double, dim string")
    assert value(spark, df, "accuracy_score", dims=()) == pytest.approx(2 / 3)


def test_positive_value_is_the_larger_of_two(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, "b"), (1, None)], "y int, g string")
    assert {r["grp"]: r["positive_rate"] for r in group_positive_rates(df, "y", "g").collect()} == {"a": 0.5, "b": 1.0}
    three = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "y int, g string")
    assert group_positive_rates(three, "y", "g").first()["positive_rate"] == pytest.approx(1 / 3)
    assert smallest_positive_rate(group_positive_rates(df.limit(0), "y", "g")).first()["value"] == 0.0


def test_argmax_takes_the_first(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],)], "s array<double>")
    assert df.select(clean.argmax_index("s")).first()[0] == 1


@pytest.mark.parametrize("op,v,t,want", [
    ("gt", 1.0, 1.0, False), (">", 2.0, 1.0, True), ("lt", 0.5, 1.0, True), ("<", 1.0, 1.0, False),
    (">=", 1.0, 1.0, True), ("<=", 1.0, 1.0, True), ("==", 1.0, 1.0, True), ("huh", 1.0, 1.0, None),
])
def test_operators(spark, op, v, t, want):
    got = spark.range(1).select(compare(F.lit(v), F.lit(op), F.lit(t))).first()[0]
    assert got is want


def test_lists_in_text(spark):
    df = spark.createDataFrame([("['age', 'gender']",), ("age, gender",), (None,)], "t string")
    assert [r[0] for r in df.select(as_list(F.col("t"))).collect()] == [["age", "gender"], ["age", "gender"], None]


def test_risk_bands(spark):
    rows = [("demographic_parity_diff", 0.1), ("predictive_parity", 0.15), ("equalized_odds_ratio", 0.3),
            ("k_anonymity", 5.0), ("k_anonymity", 2.0), ("k_anonymity", 1.0), ("data_minimization", 0.6), ("accuracy_score", 0.1)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = [r[0] for r in df.select(risk_band(F.col("k"), F.col("v"))).collect()]
    assert got == ["low", "medium", "high", "low", "medium", "high", "medium", "calculated"]


def test_confusion_matrix_has_all_labels(spark):
    got = confusion_wide(frame(spark, [(0, 0, "A"), (0, 1, "A"), (1, 1, "B")]), "target", "pred", [0, 1, 2])
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 0), (1, 0, 1, 0)]


def test_cohort_defaults(spark):
    rows = [(f"p{i}", 100 + i, 0.9, 0.8 + i / 100, "M" if i % 2 else "F", None, 30 + i, "lung", None, None) for i in range(6)]
    df = spark.createDataFrame(rows, (
        "PatientID string, SpineVol long, Confidence double, Dice double, Sex string, Manufacturer string, Age int, "
        "`Primary cancer` string, Lytic string, Blastic string"
    ))
    got = cohort.cohort_metrics(df).first()
    assert got["min_scanner_dice"] == 1.0 and got["min_lesion_type_dice"] == 1.0
    assert got["age_bias"] == 0.0 and got["confidence_correlation"] is None
    assert got["minority_sex_prop"] == 0.5 and got["min_cancer_dice"] == pytest.approx(0.825)


def test_rescale_and_mask(spark):
    df = spark.createDataFrame([(2.0, 3.0, -1.0), (float("nan"), 1.0, 0.0), (2.0, None, None)], "v double, k double, b double")
    assert [r[0] for r in df.select(clean.rescaled("v", "k", "b")).collect()] == [5.0, 0.0, 2.0]
    classes = spark.createDataFrame([(18, [18]), (19, [18]), (92, []), (5, None)], "c int, chosen array<int>")
    assert [r[0] for r in classes.select(volumes.spine_mask("c", F.col("chosen"))).collect()] == [1, 0, 1, 0]


def test_registry_takes_user_metrics(spark):
    register_metric(Metric("error_rate", lambda: 1 - F.col("hits") / F.col("n"), "rows", "performance", 0.0, "wrong share"))
    try:
        assert value(spark, frame(spark, [(1, 1, "A"), (1, 0, "A")]), "error_rate", dims=()) == 0.5
        assert metric_catalogue(spark, "parity|odds").count() == 5 - 1
    finally:
        del METRICS["error_rate"]
