"""A corpus pipeline: toxic documents go, copies and near copies go, sources are mixed, the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. `run` writes every result as Parquet to the
shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from equigauge.llm.queries import tokenizer_path
from equigauge.llm.text import whole
from equigauge.session import settle, ship_package

#: Near duplicates: shingles of this many words, and the share of the union that two documents have in common.
NEAR_WORDS, NEAR_SHARE = 5, Fraction(4, 5)


def _digest() -> Column:
    return F.sha2(whole(), 256)


def _node(digest: Column) -> Column:
    """A row by doc_id and text, as a 64-bit hash of both; the chance that two rows share one is theirs over 2^64."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", digest)


def _rows(docs: DataFrame, *named: Column) -> DataFrame:
    """The columns of `docs` as one struct, so that no name of theirs meets one of ours, besides `named`."""
    return docs.select(F.struct(*docs.columns).alias("row"), *named)


def _kept(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `docs` whose node is not in `gone` (node, distinct); of rows that repeat a node, the least in its JSON form.

    Which nodes repeat is counted without the rows, so the rows themselves are moved once, or not at all where few go.
    """
    gone, keyed = settle(gone.toDF("gone")), _rows(docs, _node(_digest()).alias("of"))
    left = keyed.select("of").join(gone, F.col("of") == F.col("gone"), "left_anti")
    repeated = settle(left.groupBy("of").count().filter("count > 1").select(F.col("of").alias("gone")))
    least = keyed.join(repeated, F.col("of") == F.col("gone"), "left_semi").groupBy("of").agg(F.min_by("row", F.to_json("row")).alias("row"))
    kept = keyed.join(gone.union(repeated), F.col("of") == F.col("gone"), "left_anti")
    return kept.select("row").union(least.select("row")).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It is fitted on the given documents that have labels.

    NULL and empty texts score 0 and stay; NULL ids and repeated rows are judged like others. Columns of any name come
    through.
    """
    ship_package(spark)
    weights = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    others = [c for c in docs.columns if c != "text"]
    scored = toxicity.with_scores(docs.select("text", F.struct(*others).alias("row")), weights)
    return scored.filter(F.col("toxicity_score") < toxicity.THRESHOLD).select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row with the largest doc_id; a row with a NULL doc_id only if there are no others.

    NULL and empty texts are equal to each other.
    """
    ship_package(spark)
    gone = exact_dedup.exact_dedup(docs).filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return _kept(docs, gone.select(_node(F.col("text_sha256"))).distinct())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of `NEAR_SHARE` reach from each other, the one with the least doc_id, NULL last.

    NULL and empty texts link with nothing and stay.
    """
    ship_package(spark)
    node = _node(_digest())
    groups = ngram_join.jaccard_groups(docs.select(node.alias("doc_id"), "text"), NEAR_WORDS, NEAR_SHARE)
    told = settle(groups.select(F.col("doc_id").alias("node"), "component_id").distinct())
    named = docs.select(node.alias("of"), F.col("doc_id").alias("id"), _digest().alias("digest")).join(told, F.col("of") == F.col("node"))
    stays = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "digest", "node")).alias("best"))
    gone = told.select("node").join(stays.select(F.col("best.node").alias("kept")), F.col("node") == F.col("kept"), "left_anti")
    return _kept(docs, gone)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them. NULL and empty texts have no words and are not taken."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences. NULL and empty texts give the end id alone."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: A trained score, unions over links of links and a tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
