"""Benchmark decontamination against a dictionary of windows, and its index against plain search."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from equigauge.llm.decontamination import contamination, index_shards, remove_passages, search_shards
from equigauge.llm.fm_index import FMIndex, suffix_order

from .brute import bench_words, contaminated
from .conftest import LONG, PASSAGE, SCHEMA

ITEMS = [
    (1, PASSAGE + " and more words behind it"), (2, "two words"), (3, None), (4, ""), (5, " ... "), (6, "a" * 400), (7, " ".join(["x"] * 30)),
    (7, "a second text of the same item that nobody has"), (None, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (8, LONG[5_000:9_000]), (10, PASSAGE), (9, "w1 w2"),
]
ITEM_SCHEMA = "item_id long, text string"


def told(rows):
    return sorted(((r["doc_id"], r["n_words"], [k for s in r["spans"] for k in range(s["start"], s["end"])], r["items"]) for r in rows), key=repr)


@pytest.mark.parametrize(("shard_words", "block_words"), [(1 << 20, 1 << 18), (50, 60)])
def test_finds_agree_with_a_dictionary(spark, odd, odd_rows, shard_words, block_words):
    more = [(20, " ".join(["x"] * 45), "n", None, 1), (20, "Two, words! " * 30, None, None, None), (None, "TWO words", None, None, None)]
    docs = odd.union(spark.createDataFrame(more, SCHEMA)).withColumnRenamed("lang", "row").withColumnRenamed("source", "items")
    items = spark.createDataFrame([(*i, "extra") for i in ITEMS], ITEM_SCHEMA + ", doc_id string")
    shards = index_shards(docs.repartition(3), shard_words=shard_words)
    rows = search_shards(shards, items, block_words=block_words).collect()
    want = contaminated([(r[0], r[1]) for r in odd_rows + more], ITEMS)
    assert told(rows) == sorted(want, key=repr)
    assert (shards.count() > 30) == (shard_words == 50)


def test_digests_of_the_query(spark, odd, odd_rows):
    got = {r["doc_id"]: r for r in contamination(odd, spark.createDataFrame(ITEMS, ITEM_SCHEMA)).collect()}
    for doc, words, hit, found in contaminated([(r[0], r[1]) for r in odd_rows], ITEMS):
        r = got[doc]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (words, len(hit), len(found), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_nothing_to_find(spark, odd, empty):
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert contamination(empty, spark.createDataFrame(ITEMS, ITEM_SCHEMA)).count() == 0
    assert contamination(odd, none).filter("contaminated OR n_hit > 0 OR n_items > 0").count() == 0
    assert contamination(odd, none).count() == odd.count()


def test_removed_passages_are_gone(spark, odd, odd_rows):
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    out = remove_passages(odd, items)
    assert out.columns == odd.columns and out.count() == odd.count()
    left = {r["doc_id"]: r["text"] for r in out.collect()}
    for doc, words, hit, _ in contaminated([(r[0], r[1]) for r in odd_rows], ITEMS):
        text = next(r[1] for r in odd_rows if r[0] == doc)
        if hit:
            assert bench_words(left[doc]) == [w for k, w in enumerate(bench_words(text)) if k not in set(hit)]
        else:
            assert left[doc] == text
    with pytest.raises(ValueError, match="used inside"):
        remove_passages(odd.withColumnRenamed("lang", "__passages"), items)


@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=6), st.lists(st.integers(0, 4), min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_index_finds_what_plain_search_finds(texts, phrase):
    sizes = np.array([len(t) for t in texts])
    index = FMIndex.build(pa.array([b"w%d" % w for t in texts for w in t], pa.binary()), sizes)
    index = FMIndex.loaded(index.stored())
    which, low, high = index.search(index.numbers(pa.array([b"w%d" % w for w in phrase], pa.binary()))[None, :])
    begins = np.cumsum(sizes + 1) - sizes - 1
    want = sorted(int(b) + k for t, b in zip(texts, begins) for k in range(len(t) - len(phrase) + 1) if t[k:k + len(phrase)] == phrase)
    found = sorted(index.locate(np.arange(low[0], high[0])).tolist()) if len(which) else []
    assert found == want


@given(st.lists(st.integers(0, 2), max_size=200))
@settings(max_examples=100, deadline=None)
def test_suffix_order(symbols):
    symbols = np.array([*symbols, 9], np.int64)
    assert suffix_order(symbols).tolist() == sorted(range(len(symbols)), key=lambda k: symbols[k:].tolist())
