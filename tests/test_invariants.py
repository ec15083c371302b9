"""Properties that hold for any table."""

import random

import pytest
from pyspark.sql import functions as F

from equigauge.catalog.fairness import FAIRNESS_KEYS
from equigauge.operators import privacy
from equigauge.operators.components import Lens
from equigauge.operators.metrics import measure


def decisions_of(spark, seed):
    random.seed(seed)
    rows = [(random.randrange(2), random.randrange(2), random.choice("aaaabc"), random.randrange(4)) for _ in range(300)]
    return spark.createDataFrame(rows, "y int, p int, g string, q int")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_order_and_relations(spark, seed):
    df = decisions_of(spark, seed)
    lens = [Lens("g", "y", "p", ("g",))]
    wanted = [("g", k, None) for k in FAIRNESS_KEYS]
    got = {r["metric_key"]: r["value"] for r in measure(df, lens, wanted).collect()}
    shuffled = {r["metric_key"]: r["value"] for r in measure(df.orderBy(F.rand(5)).repartition(7), lens, wanted).collect()}
    assert got == shuffled
    assert got["equal_opportunity_diff"] <= got["equalized_odds_ratio"]
    assert got["predictive_equality_diff"] == pytest.approx(got["true_negative_rate_diff"])
    assert all(0 <= v <= 1 for v in got.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_more_quasi_identifiers_never_raise_k(spark, seed):
    df = decisions_of(spark, seed)
    ks = [privacy.k_anonymity(df, ["g", "q", "y"][:n]).first()["k"] for n in (1, 2, 3)]
    assert ks == sorted(ks, reverse=True)


def test_l_is_at_most_k(spark):
    df = decisions_of(spark, 9)
    assert privacy.l_diversity(df, ["g"], "q").first()["l"] <= privacy.k_anonymity(df, ["g"]).first()["k"]


def test_empty_table(spark):
    df = decisions_of(spark, 1).limit(0)
    assert privacy.k_anonymity(df, ["g"]).first()["k"] == 0
    assert privacy.t_closeness(df, ["g"], "q").first()["t"] == 0.0
    assert measure(df, [Lens("g", "y", "p", ("g",))], [("g", "disparate_impact", None)]).count() == 0
