"""Streams: several batches, late rows, restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from equigauge.streaming import monitor as live
from equigauge.streaming.intake import take_in
from equigauge.streaming.live import live_monitor

SCHEMA = "ts timestamp, grp string, target int, prediction int"
DAY = dt.datetime(2024, 1, 1)


def write(spark, folder, name, rows):
    spark.createDataFrame([(DAY + dt.timedelta(hours=h), g, y, p) for h, g, y, p in rows], SCHEMA).coalesce(1).write.parquet(str(folder / name))


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(spark, folder, "b1", [(1, "a", 1, 1), (2, "a", 0, 1), (3, "b", 1, 0), (30, "a", 1, 1), (4, None, 1, 1)])
    return folder


def stream(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return live.read_stream(spark, f"{folder}/*", schema)


def test_windows_close_and_late_rows_are_dropped(spark, source, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    counts = live.windowed_confusion(stream(spark, source), "ts", "grp", "target", "prediction")
    live.run_to_table(counts, out, checkpoint=state).awaitTermination()
    first = live.landed(spark, out, counts.schema)
    assert {(r["grp"], r["n"], r["tp"], r["fp"], r["fn"]) for r in first.collect()} == {("a", 2, 1, 1, 0), ("b", 1, 0, 0, 1)}
    # The first day is closed: a row for it is late. The second day stays open for its rows.
    write(spark, source, "b2", [(5, "b", 1, 1), (31, "b", 0, 0), (60, "a", 1, 1)])
    live.run_to_table(counts, out, checkpoint=state).awaitTermination()
    rows = live.landed(spark, out, counts.schema).collect()
    assert {(r["window_start"].day, r["grp"], r["n"]) for r in rows} == {(1, "a", 2), (1, "b", 1), (2, "a", 1), (2, "b", 1)}


def test_gaps_and_alerts(spark, source, tmp_path):
    rows = live.monitor(stream(spark, source), str(tmp_path / "m"), "ts", "grp", "target", "prediction")
    gaps = {r["metric_key"]: r["value"] for r in live.window_gaps(rows).collect()}
    assert gaps["demographic_parity_diff"] == 1.0 and gaps["equal_opportunity_diff"] == 1.0
    broken = live.alerts(live.window_gaps(rows), [("demographic_parity_diff", "<", 0.5), ("predictive_equality_diff", "<=", 1.0)])
    assert [(r["metric_key"], r["message"]) for r in broken.collect()] == [("demographic_parity_diff", "1.0000 < 0.5000")]


def test_running_counts_keep_their_last_state(spark, source, tmp_path):
    write(spark, source, "b2", [(40, "a", 1, 1), (41, "c", 1, 1)])
    counts = live.running_counts(stream(spark, source), "grp")
    out = str(tmp_path / "counts")
    live.run_to_table(counts, out, "update").awaitTermination()
    landed = live.landed(spark, out, counts.schema)
    assert landed.select("batch").distinct().count() == 2
    assert {(r["grp"], r["n"]) for r in live.latest(landed, ["grp"]).collect()} == {("a", 4), ("b", 1), ("c", 1)}


def test_epochs_span_batches(spark, source, tmp_path):
    write(spark, source, "b2", [(6, "b", 0, 0), (50, "a", 0, 0)])
    rows = stream(spark, source).select(F.dayofmonth("ts").alias("epoch"), "target", "prediction")

    def audit(stored):
        return stored.groupBy("epoch").agg(F.count(F.lit(1)).alias("n"))

    got = live.epoch_audit(rows, str(tmp_path / "epochs"), "epoch", audit)
    assert {(r["epoch"], r["n"]) for r in got.collect()} == {(1, 5), (2, 1), (3, 1)}


def test_live_windows_go_on_and_alerts_are_raised_once(spark, source, tmp_path):
    out, state = str(tmp_path / "live"), str(tmp_path / "state")
    limits = [("demographic_parity_diff", "<", 0.5), ("equal_opportunity_diff", "<", 2.0)]
    go = lambda: live_monitor(stream(spark, source), out, "ts", "grp", "target", "prediction", limits=limits, checkpoint=state)
    first = go()
    told = {(r["window_start"].day, r["grp"]): (r["n"], r["tp"], r["open"], r["batch"]) for r in first.counts.collect()}
    assert told == {(1, "a"): (2, 1, False, 0), (1, "b"): (1, 0, False, 0), (2, "a"): (1, 1, True, 0)}
    assert [(r["window_start"].day, r["metric_key"], r["value"], r["open"]) for r in first.alerts.collect()] == [(1, "demographic_parity_diff", 1.0, False)]
    # A late row of the closed day is dropped; the second day shows a gap while it is open, and again in the next batch.
    write(spark, source, "b2", [(5, "b", 1, 1), (31, "b", 0, 0)])
    go()
    write(spark, source, "b3", [(32, "b", 0, 0), (60, "a", 1, 1), (60, None, 1, 1)])
    last = go()
    told = {(r["window_start"].day, r["grp"]): (r["n"], r["open"]) for r in last.counts.collect()}
    assert told == {(1, "a"): (2, False), (1, "b"): (1, False), (2, "a"): (1, False), (2, "b"): (2, False), (3, "a"): (1, True)}
    raised = sorted((r["window_start"].day, r["batch"], r["open"]) for r in last.alerts.collect())
    assert raised == [(1, 0, False), (2, 1, True)]


def test_a_batch_without_rows_keeps_the_open_windows(spark, source, tmp_path):
    out, state = str(tmp_path / "live"), str(tmp_path / "state")
    live_monitor(stream(spark, source), out, "ts", "grp", "target", "prediction", checkpoint=state)
    write(spark, source, "b2", [])
    rows = live_monitor(stream(spark, source), out, "ts", "grp", "target", "prediction", checkpoint=state).counts.collect()
    assert sorted((r["window_start"].day, r["grp"], r["open"]) for r in rows) == [(1, "a", False), (1, "b", False), (2, "a", True)]


def test_epochs_are_audited_in_the_batch_that_closes_them(spark, source, tmp_path):
    write(spark, source, "b2", [(6, "b", 0, 0), (50, "a", 0, 0)])
    write(spark, source, "b3", [(7, "b", 0, 0), (80, "a", 0, 0)])
    rows = stream(spark, source).select(F.dayofmonth("ts").alias("epoch"), "target", "prediction")
    seen = []

    def audit(stored):
        seen.append(sorted(r[0] for r in stored.select("epoch").distinct().collect()))
        return stored.groupBy("epoch").agg(F.count(F.lit(1)).alias("n"))

    got = live.epoch_audit(rows, str(tmp_path / "epochs"), "epoch", audit)
    assert {(r["epoch"], r["n"], r["batch"], r["open"]) for r in got.collect()} == {(1, 5, 1, False), (2, 1, 2, False), (3, 1, None, True), (4, 1, None, True)}
    assert seen == [[1], [2], [3, 4]]


def test_unreadable_lines_are_set_aside(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    good = ['{"k": %d, "name": "n%d"}' % (k, k) for k in range(20)]
    (folder / "one.json").write_text("\n".join([*good, '{"k": 1', "", "  ", '{"k": "x", "name": "y"}', "plain"]))
    (folder / "two.json").write_text("\n".join([*good[:3], '{"k": null, "name": "y"}', '{"name": "y"}', '{"k": 5, "other": [1]}']))
    schema = spark.createDataFrame([], "k long, name string").schema
    taken = take_in(spark, str(folder), schema, str(tmp_path / "out"), ["k"], "*.json")
    assert taken.rows.count() == 24 and taken.rows.columns == ["file", "batch", "k", "name"]
    rejects = sorted((r["file"].rsplit("/", 1)[-1], r["reason"], r["line"]) for r in taken.rejects.collect())
    assert rejects == [("one.json", "unreadable", "plain"), ("one.json", "unreadable", '{"k": "x", "name": "y"}'), ("one.json", "unreadable", '{"k": 1'),
                       ("two.json", "no k", '{"k": null, "name": "y"}'), ("two.json", "no k", '{"name": "y"}')]
