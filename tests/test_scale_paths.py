"""Distributed formulations against brute force: hot keys, ties, both sides of every size check."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from equigauge import session
from equigauge.functions import bins
from equigauge.operators import privacy, quantiles, reweigh, sampling, volumes
from equigauge.operators.running import last_at_most, running_total, scan


@pytest.mark.parametrize("n", [1, 2, 6, 101, 30_000])
def test_quantiles_match_linear_interpolation(spark, n):
    rng = np.random.default_rng(n)
    xs = np.where(rng.random(n) < 0.4, 7.0, np.round(rng.normal(0, 50, n), 2))
    df = spark.createDataFrame([(float(x),) for x in xs] + [(None,), (float("nan"),)], "v double")
    probs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.999, 1.0]
    row = quantiles.exact_quantiles(df, "v", probs).first()
    assert row["n"] == n
    np.testing.assert_allclose([row[f"q_{i}"] for i in range(len(probs))], np.quantile(xs, probs), rtol=1e-12, atol=1e-12)


def test_a_missed_bracket_is_ranked_whole(spark, monkeypatch):
    """Brackets of no width around wrong ranks miss; the result is the same."""
    rng = np.random.default_rng(4)
    rows = [("ab"[i % 2], float(x)) for i, x in enumerate(rng.normal(0, 9, 4_000))]
    df = spark.createDataFrame(rows, "g string, v double")
    brackets = quantiles._brackets
    monkeypatch.setattr(quantiles, "_brackets", lambda *a: brackets(*a).withColumn("hi0", F.col("lo0")).withColumn("lo1", F.col("hi1")))
    for keys in ([], ["g"]):
        for r in quantiles.exact_quantiles(df, "v", [0.3, 0.8], keys).collect():
            xs = [v for g, v in rows if not keys or g == r["g"]]
            np.testing.assert_allclose([r["q_0"], r["q_1"]], np.quantile(xs, [0.3, 0.8]), rtol=1e-12)


@pytest.fixture(params=["10485760", "-1"])
def broadcasts(request, spark):
    """With lookups that Spark may broadcast, and without any."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quantiles_per_group_with_a_hot_group(spark, broadcasts):
    rng = np.random.default_rng(3)
    rows = [(f"g{i % 40}" if i % 50 == 0 else "hot", float(round(x, 3))) for i, x in enumerate(rng.exponential(9, 24_000))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in quantiles.exact_quantiles(df, "v", [0.25, 0.9], ["g"]).collect()}
    for g in {r[0] for r in rows}:
        xs = [v for k, v in rows if k == g]
        np.testing.assert_allclose([got[g]["q_0"], got[g]["q_1"]], np.quantile(xs, [0.25, 0.9]), rtol=1e-12)


def test_empty_column_has_no_quantiles(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(df, "v", [0.5]).collect() == []
    assert bins.equal_count(df, "v", 3).first()["bin"] is None


def brute_distance(rows, ordered):
    values = sorted({s for _, s in rows})
    table = np.array([sum(s == v for _, s in rows) for v in values]) / len(rows)
    out = {}
    for g in {g for g, _ in rows}:
        own = [s for k, s in rows if k == g]
        share = np.array([own.count(v) for v in values]) / len(own)
        gap = share - table
        out[g] = np.abs(np.cumsum(gap)).sum() / max(len(values) - 1, 1) if ordered else 0.5 * np.abs(gap).sum()
    return out


@pytest.mark.parametrize("ordered", [False, True])
def test_group_distances(spark, broadcasts, ordered):
    random.seed(5)
    rows = [("hot", random.choice([1, 1, 1, 2, 9])) for _ in range(300)]
    rows += [(random.choice("abcde"), random.randrange(1, 60)) for _ in range(200)] + [("one", 60), ("low", 1)]
    df = spark.createDataFrame(rows, "q string, s int")
    got = {r["q"]: r["distance"] for r in privacy.group_distances(df, ["q"], "s", ordered).collect()}
    want = brute_distance(rows, ordered)
    assert got.keys() == want.keys()
    for g, d in want.items():
        assert got[g] == pytest.approx(d, abs=1e-9)


def test_one_sensitive_value_has_no_distance(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1)], "q string, s int")
    assert privacy.t_closeness(df, ["q"], "s", ordered=True).first()["t"] == 0.0
    assert privacy.t_closeness(df, ["q"], "s").first()["t"] == pytest.approx(0.0)


@pytest.mark.parametrize("pieces", [None, 1, 7, 40])
def test_scans_of_a_hot_key(spark, pieces):
    """Sums, neighbours and last known values of one key with nearly all rows, some of one position, and short keys."""
    random.seed(3)
    rows = [("hot" if k % 10 else f"k{k % 70}", random.choice([5, 5, random.randrange(90)]), k, random.randrange(9), random.choice([None, k])) for k in range(900)]
    df = spark.createDataFrame([*rows, (None, 1, 1, 1, 1)], "g string, at int, tie int, v int, w int").repartition(5)
    got = {r["tie"]: r for r in scan(df, ["g"], ["at", "tie"], sums={"total": "v"}, previous={"before": "tie"}, following={"after": "tie"}, latest={"known": "w"}, pieces=pieces).collect()}
    assert len(got) == len(rows)
    if pieces:
        assert len({r["_range"] for r in got.values() if r["g"] == "hot" and r["at"] == 5}) >= min(pieces, 7) // 3
    for g in {r[0] for r in rows}:
        mine = sorted((r[1], r[2], r[3], r[4]) for r in rows if r[0] == g)
        total, known = 0, None
        for k, (_, tie, v, w) in enumerate(mine):
            total, known = total + v, known if w is None else w
            r = got[tie]
            assert (r["total"], r["known"]) == (total, known)
            assert (r["before"], r["after"]) == (mine[k - 1][1] if k else None, mine[k + 1][1] if k + 1 < len(mine) else None)


def test_running_total_over_pieces(spark):
    rows = [(i, (i * 7) % 13) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = {r["k"]: r["t"] for r in running_total(df, "k", {"t": "v"}, pieces=8).collect()}
    assert [got[i] for i in range(500)] == list(np.cumsum([v for _, v in rows]))


def test_last_mark_at_or_below(spark):
    marks = spark.createDataFrame([(0.1, 1, 10.0), (0.25, 2, 20.0), (1.0, 3, 30.0)], "c double, i int, w double")
    asked = [0.05, 0.1, 0.2, 0.25, 0.99, 1.0]
    probes = spark.createDataFrame([(x,) for x in asked], "c double")
    got = {r["c"]: r["i"] for r in last_at_most(probes, marks, "c", ["w"], pieces=4).collect()}
    assert [got[x] for x in asked] == [None, 1, 1, 2, 2, 3]


@pytest.mark.parametrize("train", [0.8, 0.5, 0.0, 1.0])
def test_exact_split_sizes(spark, train):
    rows = [(i, "hot" if i % 3 else f"g{i % 7}" if i % 10 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, g string")
    got = sampling.exact_split(df, "k", train, ["g"]).collect()
    assert sorted(r["k"] for r in got) == list(range(1000))
    for g in {r[1] for r in rows}:
        parts = [r["part"] for r in got if r["g"] == g]
        if g is None:
            assert set(parts) == {None}
        else:
            assert parts.count("train") == -(-len(parts) * int(train * 10) // 10)


def test_split_with_and_without_broadcast(spark, broadcasts):
    df = spark.range(500).select("id", (F.col("id") % 50).alias("g"))
    hashed = {r["id"]: (r["h"], r["id"]) for r in df.select("id", F.md5(F.col("id").cast("string")).alias("h")).collect()}
    got = {r["id"]: r["part"] for r in sampling.exact_split(df, "id", 0.8, ["g"]).collect()}
    for g in range(50):
        mine = sorted((k for k in hashed if k % 50 == g), key=hashed.get)
        assert [got[k] for k in mine] == ["train"] * 8 + ["test"] * 2


def test_storage_that_executors_do_not_share_is_refused(spark):
    class OnACluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}.get(key, default))})
        sparkContext = type("Context", (), {"master": "yarn"})
    with pytest.raises(ValueError, match="all executors share"):
        session.shared_folder(OnACluster, "x")


def test_split_does_not_depend_on_its_slots(spark, monkeypatch):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("g"))
    for strata in ([], ["g"]):
        want = {tuple(r) for r in sampling.exact_split(df, "id", 0.7, strata).collect()}
        monkeypatch.setattr(sampling, "DIGITS", 1)
        for rows in (3, 1_000_000):
            monkeypatch.setattr(sampling, "SLOT_ROWS", rows)
            assert {tuple(r) for r in sampling.exact_split(df, "id", 0.7, strata).collect()} == want
        monkeypatch.undo()


def series_rows(seed=1):
    random.seed(seed)
    rows = [("hot", random.choice([0.0, 1.5, 1.5, round(random.uniform(0, 900), 1)])) for _ in range(1500)]
    return rows + [(random.choice("abc"), round(random.uniform(0, 50), 1)) for _ in range(200)] + [("single", 4.0)]


@pytest.mark.parametrize("pieces", [None, 16, 300])
def test_spacing_of_a_hot_series_with_ties(spark, pieces):
    rows = series_rows()
    df = spark.createDataFrame(rows, "s string, z double").repartition(6)
    got = {r["s"]: r for r in volumes.spacing_stats(df, "s", "z", pieces).collect()}
    assert "single" not in got
    for s in {"hot", "a", "b", "c"}:
        d = np.diff(sorted(z for k, z in rows if k == s))
        want = (d.mean(), d.std(), d.min(), d.max())
        np.testing.assert_allclose([got[s][c] for c in ("mean_gap", "std_gap", "min_gap", "max_gap")], want, atol=1e-9)
        assert got[s]["uneven"] == bool(d.std() > 0.1) and got[s]["repeated"] == bool(d.min() < 0.01)


@pytest.mark.parametrize("pieces", [None, 7, 200])
def test_slice_index_of_a_hot_series(spark, pieces):
    rows = [(s, z if i % 9 else None, i) for i, (s, z) in enumerate(series_rows(2))]
    df = spark.createDataFrame(rows, "s string, z double, i int").repartition(6)
    got = {r["i"]: r["slice"] for r in volumes.slice_index(df, "s", "z", "i", pieces).collect()}
    for s in {r[0] for r in rows}:
        order = sorted(((z or 0.0), i) for k, z, i in rows if k == s)
        assert [got[i] for _, i in order] == list(range(len(order)))


def test_mean_step_falls_back(spark):
    df = spark.createDataFrame([("a", 0.0, 9.0), ("a", 6.0, 9.0), ("a", 2.0, 9.0), ("b", 1.0, 2.5), ("c", 1.0, 0.0), ("d", 3.0, 1.0), ("d", 3.0, 1.0)],
                               "s string, z double, t double")
    got = {r["s"]: r["step"] for r in volumes.mean_step(df, "s", "z", "t").collect()}
    assert got == {"a": 3.0, "b": 2.5, "c": 1.0, "d": 1.0}


def test_flips(spark):
    rng = np.random.default_rng(0)
    image = rng.random((5, 4)) * 400
    mask = np.zeros((5, 4), int)
    mask[0:2, 1:3] = 1
    cube = [("p", x, y, 0, float(image[x, y])) for x in range(5) for y in range(4)]
    marks = [("p", x, y, 0, int(mask[x, y])) for x in range(5) for y in range(4)]
    dense = spark.createDataFrame(cube, "patient string, x int, y int, z int, value double")
    seg = spark.createDataFrame(marks, "patient string, x int, y int, z int, mask int")
    extent = spark.createDataFrame([("p", 5, 4), ("empty", 5, 4)], "patient string, width int, height int")
    got = {r["patient"]: r for r in volumes.best_flip(dense, seg, "patient", extent).collect()}
    tried = [mask, mask[:, ::-1], mask[::-1, :], mask[::-1, ::-1]]
    scores = [float((m * (image > 200)).sum() / m.sum()) for m in tried]
    assert got["p"]["flip_no"] == int(np.argmax(scores)) and got["p"]["score"] == pytest.approx(max(scores))
    assert (got["empty"]["flip"], got["empty"]["score"], got["empty"]["low_overlap"]) == ("original", 0.0, True)


@pytest.mark.parametrize("size", [(5, 4), (64, 3), (65, 2), (130, 3), (200, 5)])
def test_flips_of_wide_images(spark, size):
    rng = np.random.default_rng(size[0])
    image, mask = rng.random(size) * 400, rng.random(size) < 0.2
    rows = [("p", x, y, 1, float(image[x, y]), int(mask[x, y])) for x in range(size[0]) for y in range(size[1])]
    voxels = spark.createDataFrame(rows, "patient string, x int, y int, z int, value double, mask int")
    lines = volumes.packed(voxels, "patient", {"bone": F.col("value") > 200, "seg": F.col("mask") > 0})
    assert lines.count() == size[1] * -(-size[0] // 64)
    got = volumes.flips_of(lines, "patient").first()
    scores = [float((m * (image > 200)).sum() / m.sum()) for m in (mask, mask[:, ::-1], mask[::-1, :], mask[::-1, ::-1])]
    assert got["flip_no"] == int(np.argmax(scores)) and got["score"] == pytest.approx(max(scores))


def test_weights_even_out_groups(spark):
    random.seed(8)
    rows = [(random.choice("aab"), int(random.random() < 0.3)) for _ in range(400)] + [(None, 1), ("a", None)]
    df = spark.createDataFrame(rows, "g string, y int")
    out = reweigh.reweighed(df, "g", "y")
    assert out.count() == len(rows) and out.filter("g is null or y is null").select("weight").distinct().collect()[0][0] == 1.0
    rates = [r["weighted_rate"] for r in reweigh.weighted_rates(out.filter("y is not null"), "g", "y", "weight").collect()]
    assert rates[0] == pytest.approx(rates[1])


def test_codes_other_than_zero_and_one_are_weighted(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 2)], "g string, y int")
    assert {(r["g"], r["y"]): r["weight"] for r in reweigh.cell_weights(df, "g", "y").collect()} == {
        ("a", 1): 0.5, ("a", 2): 1.5, ("b", 2): 0.75,
    }


def test_smoothing_matrix_mirrors_the_ends():
    counts = np.array([5.0, 0, 0, 1, 2, 0, 0, 0, 9])
    kernel = np.array(reweigh.gaussian_kernel())
    padded = np.pad(counts, 4, mode="symmetric")
    want = [float((padded[i:i + 9] * kernel).sum()) for i in range(9)]
    np.testing.assert_allclose(np.array(reweigh.smoothing_matrix(9)) @ counts, want)


def test_fingerprint_ignores_order_but_not_content(spark):
    from equigauge.plans.provenance import fingerprint

    df = spark.createDataFrame([(i, f"r{i}") for i in range(100)], "i int, t string")
    first = fingerprint(df).first()
    assert fingerprint(df.orderBy(F.desc("i")).repartition(7)).first() == first and len(first["data_hash"]) == 64
    assert fingerprint(df.filter("i <> 3")).first()["data_hash"] != first["data_hash"]


def test_equal_width_keeps_both_ends(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 2.0, 2.1, 9.9, 10.0)] + [(None,)], "v double")
    assert [r["bin"] for r in bins.equal_width(df, "v", 5).collect()] == [1, 1, 2, 5, 5, None]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert {r["bin"] for r in bins.equal_width(flat, "v", 4).collect()} == {1}


def test_scratch_removes_what_was_stored_inside(spark, tmp_path):
    kept = session.settle(spark.range(3))
    with session.scratch():
        inner = session.settle(spark.range(5))
        inner.write.parquet(str(tmp_path / "out"))
    assert kept.count() == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 5
    with pytest.raises(Exception, match="(?i)does not exist|FILE_NOT_EXIST|PATH_NOT_FOUND"):
        inner.collect()
