"""What the plans read and move."""

from pyspark.sql import functions as F

from equigauge import session
from equigauge.catalog import volumes as catalog_volumes
from equigauge.catalog.frames import customers, decisions, table
from equigauge.operators import cohort, components, privacy, quantiles, reweigh, running, sampling, volumes
from equigauge.operators.components import Lens, class_counts
from equigauge.plans.enforce import enforce
from equigauge.sources.policies import Control
from equigauge.session import attach


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_audit_reads_the_table_once(spark, small):
    """All controls and both result tables come from one set of counts."""
    controls = [
        Control("a", "accuracy_score", ">", 0.1), Control("b", "demographic_parity_diff", "<", 0.5, dimension="lang"),
        Control("c", "equalized_odds_ratio", "<", 0.5, dimension="source"), Control("d", "predictive_parity", "<", 0.5, dimension="lang+source"),
        Control("e", "class_imbalance", ">", 0.1),
    ]
    run = enforce(decisions(spark, small), controls, target="target", prediction="prediction")
    assert run.results.filter("evaluated").count() == 5
    run.results.collect()
    final = plan(run.results).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final


def test_building_an_audit_runs_no_job(spark, small):
    df = decisions(spark, small)
    spark.sparkContext.setJobGroup("building", "an audit is built")
    enforce(df, [Control("b", "demographic_parity_diff", "<", 0.5, dimension="lang"), Control("x", "accuracy_score", ">", 0.1, dimension="doc_id")],
            target="target", prediction="prediction")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_share_the_scan(spark, small):
    df = decisions(spark, small)
    lenses = [Lens("l", "target", "prediction", ("lang",)), Lens("s", "target", "prediction", ("source",))]
    counts = class_counts(df, lenses)
    wide = components.lens_components(counts)
    wide.collect()
    final = plan(wide).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final


def test_only_needed_columns_are_read(spark, small):
    text = plan(privacy.k_anonymity(customers(spark, small), ["c_mktsegment"]))
    assert "o_orderpriority" not in text and "c_acctbal" not in text
    scan = plan(components.group_confusion(decisions(spark, small), "lang", "target", "prediction"))
    assert "text#" not in scan and "PushedFilters: [IsNotNull(doc_id), IsNotNull(lang)]" in scan.replace("IsNotNull(lang), IsNotNull(doc_id)", "IsNotNull(doc_id), IsNotNull(lang)")


def test_small_lookups_do_not_shuffle_the_table(spark, small):
    rows = table(spark, small, "orders").select("o_orderkey", "o_orderpriority", F.lit(1).alias("y"))
    assert "Exchange hashpartitioning" not in plan(reweigh.reweighed(rows, "o_orderpriority", "y"))
    lookup = rows.groupBy("o_orderpriority").count()
    assert "BroadcastHashJoin" in plan(attach(rows, lookup, ["o_orderpriority"]))


def test_fixed_sample_sorts_per_task(spark, small):
    assert "TakeOrderedAndProject" in plan(sampling.fixed_sample(table(spark, small, "orders"), "o_orderkey", 10))


def test_hash_split_moves_nothing(spark, small):
    assert "Exchange" not in plan(sampling.hash_split(table(spark, small, "orders"), "o_orderkey"))


def test_exact_split_only_compares(spark, small):
    rows = table(spark, small, "orders").select("o_orderkey", "o_orderpriority")
    for strata in ([], ["o_orderpriority"]):
        text = plan(sampling.exact_split(rows, "o_orderkey", 0.8, strata))
        assert "Window" not in text and "Exchange hashpartitioning" not in text
        # The rows are read once; what else is read is the stored border of each stratum.
        assert text.count("orders.parquet") == 1 and text.count("FileScan") == 1 + len(strata)


def test_cohort_and_masks_read_their_voxels_once(spark, small, monkeypatch):
    """What is stored on the way comes from the table in one read each; the rest works on what is stored."""
    read = []

    def counted(df, settle=session.settle):
        read.append(plan(df).count("embeddings.parquet"))
        return settle(df)

    for module in (cohort, quantiles, running, volumes):
        if hasattr(module, "settle"):
            monkeypatch.setattr(module, "settle", counted)
    # The cohort joins the scores with metadata of the same table, so two scans are one read of the voxels.
    rows = catalog_volumes._cohort(spark, small)
    assert plan(cohort.cohort_metrics(rows, catalog_volumes._NAMES)).count("embeddings.parquet") == 0
    assert sum(read) == 2
    read.clear()
    assert plan(catalog_volumes.orient_best(spark, small)).count("embeddings.parquet") == 0
    assert sum(read) == 1
