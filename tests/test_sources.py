"""Readers, writers and reports."""

import json

import pytest

from equigauge import schemas
from equigauge.operators import frames
from equigauge.plans import report
from equigauge.plans.enforce import enforce
from equigauge.plans.provenance import fingerprint, run_record
from equigauge.sources import sinks, tables
from equigauge.sources.policies import Control


def test_csv_without_nan(spark, tmp_path):
    (tmp_path / "c.csv").write_text("PatientID,SpineVol,Confidence,Dice,Jaccard\np1,5,0.9,NaN,\np2,6,0.8,0.7,0.5\n")
    df = tables.read_delimited(spark, str(tmp_path / "c.csv"), schemas.COHORT)
    assert df.schema == schemas.COHORT
    assert [(r["Dice"], r["Jaccard"]) for r in df.orderBy("PatientID").collect()] == [(None, None), (0.7, 0.5)]


def test_fallback_table_has_the_same_schema(spark, tmp_path):
    sample = spark.createDataFrame([("x", "17")], "race string, age string")
    got = tables.read_or_sample(spark, str(tmp_path / "absent"), sample, schemas.FACES)
    assert got.schema.simpleString() == schemas.FACES.simpleString() and got.first()["age"] == 17
    sample.write.parquet(str(tmp_path / "there"))
    assert tables.read_or_sample(spark, str(tmp_path / "there"), sample.limit(0), schemas.FACES).count() == 1


def test_file_listing(spark, tmp_path):
    for path in ("p1/CT-1/b.dcm", "p1/CT-1/a.dcm", "p1/SEG-1/s.dcm", "p2/CT/x.dcm", "p2/note.txt", "p3/SEGroot/t.dcm", "p4/SEG_root/u.dcm"):
        file = tmp_path / "root" / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")
    files = tables.split_listing(tables.list_files(spark, str(tmp_path / "root"), id_pattern=r"([^/]+)/[^/]+/[^/]+$"))
    assert sorted((r["owner"], r["kind"]) for r in files.collect()) == [
        ("p1", "ct"), ("p1", "ct"), ("p1", "seg"), ("p2", "ct"), ("p3", "seg"), ("p4", "seg")]
    assert [r["path"][-5:] for r in files.filter("owner = 'p1' AND kind = 'ct'").orderBy("rank").collect()] == ["a.dcm", "b.dcm"]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    from equigauge.operators.volumes import first_file

    first = {r["owner"]: r["first_path"] for r in first_file(files.filter("kind = 'ct'"), "owner", "path").collect()}
    assert first["p1"].endswith("p1/CT-1/a.dcm")


@pytest.mark.parametrize("wrap", [lambda x: x, lambda x: {"metrics": x}])
def test_results_in_both_forms(spark, tmp_path, wrap):
    items = [{"control_id": "c", "metric_key": "m", "actual_value": 0.5, "passed": True}, {"control_id": "d", "passed": False}]
    (tmp_path / "r.json").write_text("\n\t " + json.dumps(wrap(items), indent=2) + "\r\n")
    got = tables.read_results(spark, str(tmp_path / "r.json"))
    assert [(r["control_id"], r["passed"]) for r in got.orderBy("control_id").collect()] == [("c", True), ("d", False)]


def test_results_of_another_form_are_an_error(spark, tmp_path):
    (tmp_path / "r.json").write_text("not json")
    with pytest.raises(Exception, match="no results in"):
        tables.read_results(spark, str(tmp_path / "r.json")).collect()


def test_different_rows_have_different_hashes(spark):
    tell = lambda *row: fingerprint(spark.createDataFrame([row], "a string, b string")).first()["data_hash"]
    cases = [("a|b", "c"), ("a", "b|c"), ("\\N", None), (None, "\\N"), ("1:x", ""), ("1", ":x"), (None, None), ("", "")]
    assert len({tell(*c) for c in cases}) == len(cases)


def test_a_rerun_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "results")
    one = spark.createDataFrame([("p1", 0.9)], "PatientID string, Dice double")
    sinks.append_results(one, path, "run-1")
    sinks.append_results(one, path, "run-2")
    sinks.append_results(one, path, "run-2")
    stored = spark.read.parquet(path)
    assert sorted(r["run_id"] for r in stored.collect()) == ["run-1", "run-2"]
    todo = spark.createDataFrame([("p1",), ("p2",)], "PatientID string")
    assert [r[0] for r in frames.pending(todo, stored, "PatientID").collect()] == ["p2"]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(1, 1, "a"), (0, 1, "a"), (1, 1, "b"), (0, 0, "b")], "y int, p int, g string")
    controls = [Control("acc", "accuracy_score", ">=", 0.5, description="right share", article="15"),
                Control("dp", "demographic_parity_diff", "<", 0.1, dimension="g", severity="high")]
    return enforce(df, controls, target="y", prediction="p", phase="post").results


def test_report_file(spark, tmp_path, results):
    sinks.write_report(report.report_rows(results), str(tmp_path / "r"), ["# Findings", "| id | ok | value | limit |", "|---|---|---|---|"])
    lines = [x for f in sorted((tmp_path / "r").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == ["# Findings", "| id | ok | value | limit |", "|---|---|---|---|",
                     "| acc | ✅ | 0.750 | 0.5 |", "| dp | ❌ | 0.500 | 0.1 |"]
    section = report.report_sections(results).orderBy("requirement_id").first()["section"]
    assert section.splitlines()[0] == "### ✅ acc" and "- **Result**: 0.7500 >= 0.5000" in section


def test_log_summary_and_bundle(spark, tmp_path, results):
    sinks.append_log(report.metric_log(results, "post_training"), str(tmp_path / "log"))
    log = {r["key"]: r["value"] for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert log["post_training.governance.acc.pass"] == 1.0 and log["governance.overall_pass"] == 0.0
    assert log["post_training.metrics.demographic_parity_diff"] == 0.5
    total = report.summary(results).first()
    assert (total["total"], total["passed"], total["percentage"], total["overall_pass"]) == (2, 1, 50.0, False)
    sinks.write_json(report.bundle(results.limit(0), results, mitigation="None"), str(tmp_path / "bundle"))
    text = "".join(f.read_text() for f in (tmp_path / "bundle").glob("part-*"))
    stored = json.loads(text)
    assert len(stored["post_metrics"]) == 2 and stored["training_metadata"]["mitigation"] == "None"


def test_tables_are_replaced(spark, tmp_path, results):
    for _ in range(2):
        sinks.write_table(results, str(tmp_path / "t"), ["severity"])
        sinks.write_delimited(results.select("control_id", "passed"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert tables.read_delimited(spark, str(tmp_path / "c")).count() == 2


def test_run_record(spark):
    row = run_record(spark.range(5), "r1", "reweighing").first()
    assert (row["run_id"], row["n_rows"], row["mitigation"], len(row["data_hash"])) == ("r1", 5, "reweighing", 64)


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, "x", None)], "Attribute1 int, Attribute2 int, class string, z double")
    assert frames.rename_by_position(df, ["a", "b"]).columns == ["a", "b", "class", "z"]
    assert frames.rename_by_position(df, ["a"]).columns == df.columns
    assert frames.ensure_column(df, "gender", "unknown").first()["gender"] == "unknown"
    assert frames.drop_known(df, ["class", "nothing"]).columns == ["Attribute1", "Attribute2", "z"]
    assert frames.numeric_columns(df, ["z"]) == ["Attribute1", "Attribute2"]
    assert frames.pick_column(df, "target", "class") == "class"
    assert frames.drop_missing(df, ["z"]).count() == 0
