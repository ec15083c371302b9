"""The corpus pipeline against plain versions of its stages."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from equigauge.llm import mixing, toxicity
from equigauge.session import settle

from .brute import jaccard

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [settle(docs)]
    for _, stage in pipeline.STAGES:
        kept.append(settle(stage(spark, kept[-1], SMALL)))
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [{r["doc_id"]: r["text"] for r in k.select("doc_id", "text").collect()} for k in kept[:-1]]
    scores = {r["doc_id"]: r["toxicity_score"] for r in toxicity.with_scores(docs, toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))).collect()}
    assert set(rows[1]) == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
    last: dict = {}
    for d, t in rows[1].items():
        last[t] = max(last.get(t, d), d)
    assert set(rows[2]) == set(last.values())
    assert set(rows[3]) == {d for d, _, c in jaccard(rows[2].items(), 5, 80, 100) if d == c}
    times = Counter(r["doc_id"] for r in kept[4].select("doc_id").collect())
    assert set(times) <= set(rows[3]) and max(times.values()) <= 2
    words = {d: len(t.split()) for d, t in rows[3].items()}
    assert sum(words[d] * n for d, n in times.items()) >= 1.45 * sum(words.values())
    packed = kept[5]
    assert packed.filter("start = 0").count() == sum(times.values())
    assert packed.selectExpr("sum(length)").first()[0] == packed.filter("start = 0").selectExpr("sum(doc_tokens)").first()[0]


def test_run_gives_the_last_stage(spark):
    out = pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        n = docs.count()
        for name, stage in pipeline.STAGES:
            before, docs = docs, settle(stage(spark, docs, SMALL))
            assert name == "packing" or docs.columns == before.columns
        assert (docs.count() > 0) == (n > 0)


def test_mixing_of_extra_columns(spark, odd):
    assert mixing.mixed_documents(odd.withColumnRenamed("n_chars", "taken")).columns[-1] == "taken"


#: Names that stages use inside, or used to.
INNER = ("stage_id", "stage_of", "stage_node", "stage_row", "mix_key", "mix_of", "mix_turn", "mix_repeats", "toxicity_score", "toxicity_sentences",
         "row", "id", "of", "node", "key", "repeats", "turn", "again_id", "again_of", "gone_id", "gone_of", "kept", "best", "keep_id", "digest", "bytes", "size")


def test_stages_take_columns_of_any_name_and_type(spark, odd):
    wide = odd.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in INNER}).withColumn("facts", F.create_map(F.lit("k"), "doc_id"))
    twice = wide.union(wide.filter("doc_id = 6"))
    docs = plain = None
    for name, stage in pipeline.STAGES[:-1]:
        docs = settle(stage(spark, twice if docs is None else docs, SMALL))
        plain = settle(stage(spark, odd.union(odd.filter("doc_id = 6")) if plain is None else plain, SMALL))
        assert docs.columns == wide.columns, name
        assert sorted(r["doc_id"] for r in docs.collect()) == sorted(r["doc_id"] for r in plain.collect()), name
        assert docs.filter(" OR ".join(f"{c} <> concat('{c}', doc_id)" for c in INNER)).count() == 0, name
        assert docs.filter("facts['k'] <> doc_id").count() == 0
    assert pipeline.pack_sequences(spark, docs, SMALL).count() > 0


def test_scores_do_not_hide_a_column(spark, odd):
    with pytest.raises(ValueError, match="already"):
        toxicity.with_scores(odd.withColumnRenamed("lang", "toxicity_score"), {"": 0.0})


def test_verdicts_are_per_row(spark, odd):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "a", None, "s", 1), (5, "a", None, "s", 1), (1, "unique", None, "s", 1), (1, "unique", None, "t", 1), (None, "a", None, "s", 1),
            (None, "alone", None, "s", 1), (None, "alone", None, "s", 1), (3, long, None, "s", 1), (4, long + " more", None, "s", 1),
            (4, "clean", None, "s", 1), (None, long + " other", None, "s", 1), (3, "clean too", None, "s", 1)]
    docs = settle(pipeline.drop_copies(spark, spark.createDataFrame(rows, odd.schema), SMALL))
    told = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())
    alike = [(5, "a"), (1, "unique"), (None, "alone"), (3, long), (4, "clean"), (3, "clean too")]
    assert told(docs) == Counter([*alike, (4, long + " more"), (None, long + " other")])
    assert docs.filter("text = 'unique'").first()["source"] == "s"
    assert told(pipeline.drop_near_copies(spark, docs, SMALL)) == Counter(alike)
