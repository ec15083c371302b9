"""Staged runs, own accumulators, fingerprints by part and sparse levels."""

import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from equigauge.operators import accumulators, frames
from equigauge.operators.accumulators import CalibrationError, accumulated
from equigauge.plans import provenance
from equigauge.plans.enforce import PolicyViolation, enforce
from equigauge.plans.publish import publish, published, stage, versions
from equigauge.sources.policies import Control


def judged(rows, limit):
    return enforce(rows, [Control("a", "accuracy_score", ">=", limit)], target="y", prediction="p").results


def test_a_failed_gate_leaves_readers_on_the_old_version(spark, tmp_path):
    path = str(tmp_path / "scores")
    good = spark.createDataFrame([(k, k % 2, k % 2) for k in range(10)], "k int, y int, p int")
    bad = good.withColumn("p", 1 - F.col("p"))
    assert published(spark, path) is None and versions(spark, path).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish(path, "one", judged(good, 0.5))
    assert publish(path, "one", judged(stage(good, path, "one"), 0.5)) == 1
    with pytest.raises(PolicyViolation):
        publish(path, "two", judged(stage(bad, path, "two"), 0.5))
    assert published(spark, path).filter("y = p").count() == 10
    # The run is staged again and replaces what it left.
    assert publish(path, "two", judged(stage(good.filter("k < 4"), path, "two"), 0.5)) == 2
    assert published(spark, path).count() == 4
    assert {(r["version"], r["run_id"], r["n_controls"]) for r in versions(spark, path).collect()} == {(1, "one", 1), (2, "two", 1)}


# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Longest:
    """The largest value and how often it occurs: a state that does not add up."""

    columns = ("v",)

    def zero(self):
        return np.array([-np.inf, 0.0])

    def update(self, state, v):
        v = v[~np.isnan(v)]
        return self.merge(state, np.array([v.max(), (v == v.max()).sum()])) if len(v) else state

    def merge(self, a, b):
        return np.array([a[0], a[1] + b[1]]) if a[0] == b[0] else (a if a[0] > b[0] else b)

    def finish(self, state):
        return float(state[1]) if state[1] else None


@pytest.mark.parametrize("held", [10_000, 2])
def test_own_states_are_merged_over_a_hot_group(spark, monkeypatch, held):
    monkeypatch.setattr(accumulators, "HELD_KEYS", held)
    rows = [("hot" if k % 20 else f"k{k % 100}", float(k % 7) if k % 11 else None) for k in range(4_000)] + [(None, 9.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(9)
    got = {r["g"]: r["value"] for r in accumulated(df, ["g"], Longest()).collect()}
    want = {}
    for g in {r[0] for r in rows} - {None}:
        mine = [v for k, v in rows if k == g and v is not None]
        want[g] = float(mine.count(max(mine))) if mine else None
    assert got == want
    plan = accumulated(df, ["g"], Longest())._jdf.queryExecution().toString()
    assert "FlatMapGroups" not in plan


def test_calibration_error(spark):
    rng = np.random.default_rng(1)
    score = rng.random(500)
    rows = [("a", float(s), int(rng.random() < s**2)) for s in score] + [("a", None, 1), ("a", float("nan"), 1), ("b", 1.0, 1)]
    got = {r["g"]: r["value"] for r in accumulated(spark.createDataFrame(rows, "g string, s double, y int"), ["g"], CalibrationError("s", "y")).collect()}
    y, bins = np.array([r[2] for r in rows[:500]]), np.minimum((score * 10).astype(int), 9)
    want = sum(abs(score[bins == b].sum() - y[bins == b].sum()) for b in range(10)) / 500
    assert got["a"] == pytest.approx(want) and got["b"] == pytest.approx(0.0)


def test_a_changed_part_is_named(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(600)], "i int, t string")
    leaves = provenance.fingerprint_parts(df, keys=["i"])
    assert leaves.count() > 200 and leaves.agg(F.sum("n_rows")).first()[0] == 600
    part = df.filter("i = 7").select(provenance.part_of(["i"])).first()[0]
    other = provenance.fingerprint_parts(df.withColumn("t", F.when(F.col("i") == 7, "x").otherwise(F.col("t"))).orderBy(F.desc("i")), keys=["i"])
    assert [r["part"] for r in provenance.changed_parts(leaves, other).collect()] == [part]
    twice = provenance.fingerprint_parts(df.union(df.filter("i = 7")), keys=["i"])
    assert [(r["part"], r["rows_after"] - r["rows_before"]) for r in provenance.changed_parts(leaves, twice).collect()] == [(part, 1)]
    assert provenance.changed_parts(leaves, leaves).count() == 0
    assert provenance.fingerprint(df.limit(0)).first()["n_rows"] == 0


def test_sparse_levels_agree_with_columns(spark, monkeypatch):
    rows = [(k, "abc"[k % 3] if k % 10 else None, f"x{k % 40:02d}") for k in range(200)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    for drop in (False, True):
        dense = frames.one_hot(df, ["a", "b"], drop)
        names = dense.columns[1:]
        sparse = {r["k"]: r["at"] for r in frames.one_hot_sparse(df, ["a", "b"], drop, "at").collect()}
        assert sparse == {r["k"]: [i for i, c in enumerate(names) if r[c]] for r in dense.collect()}
    monkeypatch.setattr(frames, "MOST_LEVELS", 42)
    with pytest.raises(ValueError, match="one_hot_sparse"):
        frames.one_hot(df, ["a", "b"])


def test_medians_of_all_columns_at_once(spark):
    from equigauge.operators.reweigh import median_filled
    rows = [(float(k), float(k * k) if k % 3 else None, None) for k in range(20)] + [(None, None, None)]
    out = median_filled(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()
    assert out[-1]["a"] == np.median([r[0] for r in rows[:-1]]) and out[-1]["b"] == np.median([r[1] for r in rows if r[1] is not None])
    assert all(r["c"] is None for r in out)
