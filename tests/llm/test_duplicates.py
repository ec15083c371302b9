"""Exact copies, repeated passages, similar documents, near vectors and archives against plain versions."""

import base64
import hashlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from equigauge.llm import embedding_dedup, joins, ngram_join, suffix_dedup, warc
from equigauge.llm.components import connected_components
from equigauge.llm.embedding_dedup import near_duplicates
from equigauge.llm.exact_dedup import DIGEST_BYTES, PerfectHash, exact_dedup
from equigauge.llm.ngram_join import SignatureTree, Similarity, bitmap, jaccard_groups, shingle_sets
from equigauge.llm.suffix_dedup import DEPTH, earlier_factor, remove_repeats

from .brute import Union, jaccard, repeats, rows_of, shingles

SMALL = "/root/testdata/sf0.001"


def test_repeats_of_odd_rows(spark, odd, odd_rows, empty):
    want = sorted(repeats([(r[0], r[1]) for r in odd_rows]), key=repr)
    assert rows_of(remove_repeats(odd, texts=False)) == want
    told = remove_repeats(odd).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in told)
    assert remove_repeats(empty).count() == 0


def test_repeats_of_shared_and_null_ids(spark):
    text = "".join(f"{k} " for k in range(200))
    rows = [(None, text, 1), (3, text, 1), (3, "x" + text, 1), (None, None, 1), (2, text[50:], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bytes int")
    assert rows_of(remove_repeats(docs, texts=False)) == sorted(repeats([r[:2] for r in rows]), key=repr)


def test_repeats_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(remove_repeats(docs.repartition(5), texts=False)) == sorted(repeats(rows), key=repr)


def test_busy_names_are_dealt_by_window(spark, monkeypatch, odd_rows):
    line = "a line that very many documents share, of more than one hundred bytes in all, so that it is found whole ......."
    rows = [(k, f"{'x' * (k % 7)}{k * 7919} {line} {k * 104729}") for k in range(300)]
    want = sorted(repeats(rows), key=repr)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(remove_repeats(docs, texts=False)) == want
    batches = 4
    monkeypatch.setattr(suffix_dedup, "BUSY", 50)
    import pandas as pd
    frames = [pd.DataFrame({"batch": b, "id": [k for k, _ in rows if k % batches == b], "bytes": [t.encode() for k, t in rows if k % batches == b]}) for b in range(batches)]
    from equigauge.llm.batches import reduced
    keys = Counter()
    for f in frames:
        names, counts = suffix_dedup.names_of(f)
        keys.update(dict(zip(reduced(names, 3).tolist(), counts.tolist())))
    many = sorted((k, n) for k, n in keys.items() if n > 1)
    answers = pd.DataFrame({"batch": [0], "keys": [np.array([k for k, _ in many], "<u8").tobytes()], "totals": [np.array([n for _, n in many], "<u4").tobytes()]})
    sent = pd.concat([suffix_dedup._runs_out(5, 3)(f, answers) for f in frames])
    marks = pd.concat([suffix_dedup._marked(g) for _, g in sent.groupby("bucket")])
    got = pd.concat([suffix_dedup._cut_out_figures(f, marks[marks["batch"] == b]) for b, f in enumerate(frames)])
    assert sorted(map(tuple, got.to_numpy().tolist()), key=repr) == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab", min_size=0, max_size=60))
def test_earlier_factor_is_the_longest_previous_factor(text):
    depth = 3
    order = np.array(sorted(range(len(text) - depth + 1), key=lambda k: text[k:]), np.int64) if len(text) >= depth else np.zeros(0, np.int64)
    agrees = np.array([False, *(text[a:a + depth] == text[b:b + depth] for a, b in zip(order, order[1:]))][:len(order)], bool)
    got = dict(zip(order.tolist(), earlier_factor(order, agrees).tolist()))
    assert got == {k: text[k:k + depth] in {text[j:j + depth] for j in range(k)} for k in got}


def test_windows_are_named_by_their_content():
    data = np.frombuffer(np.random.default_rng(1).bytes(3000) * 2, np.uint8)
    bounds = np.array([0, 3000, 6000])
    runs = [np.concatenate(c) for c in zip(*suffix_dedup.window_runs(data, bounds))]
    half = runs[3] == 0
    assert (runs[0][half] == runs[0][~half] - 3000).all() and (runs[2][half] == runs[2][~half]).all()
    assert sum(runs[1] - runs[0] + 1) == 2 * (3000 - DEPTH + 1)


def test_exact_dedup(spark, odd, odd_rows, empty):
    rows = [*odd_rows, (None, None, None, None, None), (None, "only null ids", None, None, None), (7, odd_rows[6][1], "x", "y", 0)]
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    def told(r):
        ids = groups[r[1] or ""]
        best = max((i for i in ids if i is not None), default=None)
        return (r[0], best, len(ids), r[0] is not None and r[0] == best, hashlib.sha256((r[1] or "").encode()).hexdigest())
    docs = spark.createDataFrame(rows, odd.schema)
    assert rows_of(exact_dedup(docs)) == sorted(map(told, rows), key=repr)
    assert exact_dedup(empty).count() == 0


def test_large_groups_meet_their_rows_without_gathering(spark, monkeypatch):
    monkeypatch.setattr(joins, "LEAST_ROWS", 10)
    rows = spark.createDataFrame([(k, b"hot" if k % 2 else b"k%d" % (k % 40)) for k in range(200)] + [(999, None)], "id long, digest binary")
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
    met = joins.with_group(rows, groups, "digest", "size", 200)
    plan = met._jdf.queryExecution().toString()
    assert plan.count("BroadcastHashJoin") >= 1
    want = [(k, b"hot" if k % 2 else b"k%d" % (k % 40)) for k in range(200)]
    assert sorted((r["id"], bytes(r["digest"]), r["size"], r["least"]) for r in met.collect()) == [(k, d, 100 if d == b"hot" else 5, 1 if d == b"hot" else k % 40) for k, d in want]


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 400), st.integers(0, 5))
def test_perfect_hash(n, seed):
    known = np.frombuffer(np.random.default_rng(seed).bytes(n * DIGEST_BYTES), np.uint8).reshape(-1, DIGEST_BYTES)
    table = PerfectHash.build(known)
    assert sorted(table.slots(known).tolist()) == list(range(n))
    strange = np.frombuffer(np.random.default_rng(seed + 99).bytes(50 * DIGEST_BYTES), np.uint8).reshape(-1, DIGEST_BYTES)
    assert ((table.slots(strange) < n) & (table.slots(strange) >= -1)).all()


@pytest.mark.parametrize("width,share", [(3, Fraction(9, 10)), (5, Fraction(4, 5)), (1, Fraction(1, 2))])
def test_similar_documents(spark, odd, odd_rows, empty, width, share):
    rows = [r[:2] for r in odd_rows]
    assert rows_of(jaccard_groups(odd, width, share)) == sorted(jaccard(rows, width, share.numerator, share.denominator), key=repr)
    if width == 3:
        assert jaccard_groups(empty).count() == 0
        again = spark.createDataFrame([(None, "a b c d", 1), (1, "a b c d", 1), (1, "x", 1), (None, None, 1)], "doc_id long, text string, n int")
        assert rows_of(jaccard_groups(again)) == sorted([(None, 2, None), (1, 2, 1), (1, 1, 1), (None, 0, None)], key=repr)


def test_near_copies_in_parts_of_a_block(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(150)]
    rows = [(k, " ".join(base[:j] + [f"new{k}"] + base[j + 1:])) for k, j in enumerate(rng.integers(0, 150, 60).tolist())]
    rows += [(100 + k, " ".join(f"z{x}" for x in rng.integers(0, 10**6, 50).tolist())) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = jaccard(rows)
    assert rows_of(jaccard_groups(docs)) == sorted(want, key=repr)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 7)
    assert rows_of(jaccard_groups(docs)) == sorted(want, key=repr)


def test_busy_keys_are_dealt_over_parts(spark, monkeypatch):
    import pandas as pd
    rng = np.random.default_rng(6)
    base = [f"w{k}" for k in range(150)]
    rows = [(k, " ".join(base[:j] + [f"new{k}"] + base[j + 1:])) for k, j in enumerate(rng.integers(20, 150, 90).tolist())]
    rows += [(100 + k, " ".join([f"x{k // 2}", *base[:3], *(f"y{k // 2}-{j}" for j in range(30 + k % 2))])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(jaccard(rows), key=repr)
    assert rows_of(jaccard_groups(docs)) == want
    monkeypatch.setattr(ngram_join, "BUSY_ROWS", 7)
    assert rows_of(jaccard_groups(docs.repartition(3))) == want

    # All sets of one key: no group of entries is much larger than a part, and each entry is dealt twice.
    entries = spark.range(400).select(F.lit(77).cast("long").alias("key"), "id", F.col("id").alias("label"), F.lit(1).cast("long").alias("cost"))
    counts = [r["count"] for r in ngram_join.dealt(entries, 40).groupBy("key").count().collect()]
    assert max(counts) < 80 and sum(counts) == 800 and len(counts) == 20
    assert rows_of(ngram_join.dealt(entries, 400)) == rows_of(entries.select("key", "id"))


def test_links_left_join_what_dealing_kept_apart(spark):
    like = Similarity(Fraction(9, 10))
    whole = np.unique(np.random.default_rng(9).integers(0, 2**63, 100, dtype=np.uint64))
    sets = spark.createDataFrame([(k, 99, bitmap(np.delete(whole, k)).tobytes()) for k in range(30)], "id long, n long, bits binary")
    # One component of 20 entries and ten entries of their own, in parts of 4, or all in one task.
    for most in (4, 400):
        rows = spark.createDataFrame([(77, k, 0 if k < 20 else k, 1) for k in range(30)], "key long, id long, label long, cost long")
        union = Union(range(30))
        for a, b in [*((k, 0) for k in range(20)), *rows_of(ngram_join.links_left(rows, sets, like, most, 2))]:
            union.join(a, b)
        assert {union.find(k) for k in range(30)} == {0}
        one = rows.withColumn("label", F.lit(0).cast("long"))
        assert ngram_join.links_left(one, sets, like, most, 2).count() == 0


@pytest.mark.parametrize("share", [Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)])
def test_similar_sets_have_a_key_in_common(share):
    """Also sets whose hashes crowd in a corner, so that most parts are empty, and sets on both sides of a band."""
    rng = np.random.default_rng(11)
    keys, like = ngram_join.Keys(Similarity(share)), Similarity(share)
    for k in range(300):
        n = int(rng.integers(2, 60)) if k % 3 else int(rng.integers(60, 900))
        top = 2**40 if k % 5 == 0 else 2**64 - 1
        both = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        most = int(len(both) * (1 / share - 1))
        a = np.unique(np.concatenate([both, rng.integers(0, top, int(rng.integers(0, most + 1)), dtype=np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(0, top, int(rng.integers(0, most + 1)), dtype=np.uint64)]))
        overlap = len(np.intersect1d(a, b))
        if a.tolist() == b.tolist() or overlap < share * (len(a) + len(b) - overlap):
            continue
        early, late = keys.of([a, b])
        x, y = (set(np.frombuffer(early[j] + late[j], "<u8").tolist()) for j in (0, 1))
        assert x & y, (len(a), len(b), overlap)


def test_words_that_a_polynomial_takes_for_equal_are_told_apart(spark):
    """A word of 1024 letters by the rule of Thue and Morse, and its complement: equal in any polynomial modulo 2^64."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rows = [(1, one), (2, other), (3, f"x {one} y z"), (4, f"x {other} y z"), (5, f"x {one} y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard_groups(docs)) == sorted(jaccard(rows), key=repr)


def test_bitmaps_are_not_widened_to_one_far_set():
    rng = np.random.default_rng(10)
    like = Similarity(Fraction(9, 10))
    sizes = np.array([*rng.integers(20, 250, 300), 9000])
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in sizes]
    widths = np.array([len(bitmap(s)) for s in sets])
    bands = list(ngram_join.width_bands(sizes, widths, like))
    assert max(widths[at].max() for at in bands) == 4 and not any(300 in at for at in bands)
    together = {(int(a), int(b)) for at in bands for a in at for b in at}
    assert all((a, b) in together for a in range(301) for b in range(a) if 10 * min(sizes[a], sizes[b]) >= 9 * max(sizes[a], sizes[b]))


def test_tree_loses_no_pair(monkeypatch):
    rng = np.random.default_rng(7)
    like = Similarity(Fraction(4, 5))
    sets = []
    for _ in range(40):
        whole = rng.integers(0, 2**63, int(rng.integers(5, 400)), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 5))):
            keep = rng.random(len(whole)) > 0.08
            if keep.any():
                sets.append(np.unique(whole[keep]))
    tree = SignatureTree(np.array([len(s) for s in sets]), [bitmap(s) for s in sets])
    got, want = Union(range(len(sets))), Union(range(len(sets)))
    monkeypatch.setattr(ngram_join, "TABLE", 2_000)
    for a, b in tree.link(like, lambda a, b: like.hold(sets, a, b)):
        got.join(a, b)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                want.join(a, b)
    assert [got.find(k) for k in range(len(sets))] == [want.find(k) for k in range(len(sets))]


def test_a_wide_set_does_not_loosen_the_bound_of_others():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (400, 410, 420, 9000)]
    tree = SignatureTree(np.array([len(s) for s in sets]), [bitmap(s) for s in sets])
    assert tree.link(Similarity(Fraction(9, 10))) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té", max_size=25), max_size=6), st.integers(1, 4), st.sampled_from([shingle_sets, ngram_join.exact_sets]))
def test_shingle_sets_have_the_right_sizes(texts, width, sets_of):
    got = sets_of([t.encode() for t in texts], width)
    assert [len(s) for s in got] == [len(shingles(t, width)) for t in texts]
    for a, s in zip(texts, got):
        for b, t in zip(texts, got):
            assert (shingles(a, width) == shingles(b, width)) == (s.tolist() == t.tolist())


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 90), (90, 100), (95, 95), (None, 3), (200, 150), (199, 150), (200, 199)]
    got = dict(rows_of(connected_components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {**{k: 1 for k in range(2, 61)}, 100: 90, 200: 150, 199: 150}


def near_brute(rows, threshold=0.9):
    good = [(k, np.array(v, float) / max(map(abs, v))) for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, union = Counter(), Union([i for i, _ in rows if i is not None])
    for a, (k, x) in enumerate(good):
        for j, y in good[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[k] += 1
                links[j] += 1
                union.join(rows[k][0], rows[j][0])
    return sorted(((i, links[k], union.find(i) if i is not None else None, i is not None and union.find(i) == i) for k, (i, v) in enumerate(rows)), key=repr)


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, rng.standard_normal(16).tolist()) for k in range(150)]
    rows += [(200 + k, (np.array(rows[k % 9][1]) + rng.standard_normal(16) * 0.15).tolist()) for k in range(60)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [None] + [1.0] * 15), (304, [float("nan")] * 16), (305, [float("inf")] + [1.0] * 15),
             (None, rows[0][1]), (306, rows[0][1]), (307, rows[0][1]), (308, [1.0, 2.0]), (309, [2.0, 4.0]), (310, [1e300, 2e300]), (311, [-0.0, 1.0]), (312, [0.0, 1.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cell int")
    assert rows_of(near_duplicates(table)) == near_brute(rows)
    monkeypatch.setattr(embedding_dedup, "PART", 20)
    assert rows_of(near_duplicates(table)) == near_brute(rows)
    assert near_duplicates(table.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    base = embedding_dedup.unit(rng.standard_normal((1500, 64)))
    other = rng.standard_normal((1500, 64))
    other = embedding_dedup.unit(other - (other * base).sum(axis=1, keepdims=True) * base)
    pairs = np.concatenate([base, 0.905 * base + np.sqrt(1 - 0.905**2) * other])
    table = spark.createDataFrame([(k, v) for k, v in enumerate(pairs.tolist())], "vec_id long, embedding array<double>")
    got = near_duplicates(table).agg({"n_links": "sum"}).first()[0]
    true = sum(int(((pairs[a:a + 500] @ pairs.T) >= 0.9).sum()) for a in range(0, 3000, 500)) - 3000
    assert 0.9 * true <= got <= true


@pytest.mark.parametrize("many", [24, 600, 4096, 16_384])
def test_recall_of_cells_does_not_fall_with_their_number(many):
    rng = np.random.default_rng(11)
    centroids = embedding_dedup.unit(rng.standard_normal((many, 64)))
    base, other = embedding_dedup.unit(rng.standard_normal((1000, 64))), rng.standard_normal((1000, 64))
    other = embedding_dedup.unit(other - (other * base).sum(axis=1, keepdims=True) * base)
    near = 0.905 * base + np.sqrt(1 - 0.905**2) * other
    cells = zip(embedding_dedup.cells_of(base, centroids), embedding_dedup.cells_of(near, centroids))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in cells]) >= 0.995


@pytest.mark.parametrize("dimension", [8, 16, 64])
@pytest.mark.parametrize("many", [24, 400, 3000])
def test_pairs_are_found_from_one_home_at_least(dimension, many):
    """Pairs at cosine 0.905, and centroids as they are drawn: no two closer than `APART`."""
    rng = np.random.default_rng(dimension)
    kept = np.zeros((0, dimension))
    for v in embedding_dedup.unit(rng.standard_normal((many, dimension))):
        if not len(kept) or (kept @ v).max() < embedding_dedup.APART:
            kept = np.concatenate([kept, v[None]])
    base, other = embedding_dedup.unit(rng.standard_normal((800, dimension))), rng.standard_normal((800, dimension))
    other = embedding_dedup.unit(other - (other * base).sum(axis=1, keepdims=True) * base)
    a, b = (embedding_dedup.cells_of(x, kept) for x in (base, 0.905 * base + np.sqrt(1 - 0.905**2) * other))
    assert np.mean((a[:, :1] == b).any(axis=1) | (b[:, :1] == a).any(axis=1)) >= 0.97


@pytest.mark.parametrize("dimension", [8, 16, 64])
def test_recall_in_few_and_many_dimensions(spark, dimension):
    rng = np.random.default_rng(dimension)
    base = embedding_dedup.unit(rng.standard_normal((1000, dimension)))
    pairs = np.concatenate([base, embedding_dedup.unit(base + rng.standard_normal((1000, dimension)) * 0.42 / np.sqrt(dimension))])
    table = spark.createDataFrame([(k, v) for k, v in enumerate(pairs.tolist())], "vec_id long, embedding array<double>")
    got = near_duplicates(table).agg({"n_links": "sum"}).first()[0]
    true = int((pairs @ pairs.T >= 0.9).sum()) - 2000
    assert true > 500 and 0.97 * true <= got <= true


def test_estimates_are_unbiased():
    rng = np.random.default_rng(5)
    a, b = embedding_dedup.unit(rng.standard_normal((300, 64))), embedding_dedup.unit(rng.standard_normal((300, 64)))
    about, bound = embedding_dedup.estimate(a @ embedding_dedup.rotation(64), *embedding_dedup.encode(b))
    error = about - a @ b.T
    assert abs(error.mean()) < 0.005 and (np.abs(error) <= bound).mean() > 0.99


def facts(rows, least=0):
    best: dict = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= least and i is not None:
            best[p] = max(best.get(p, i), i)
    out, told = [], set()
    for i, _, h in rows:
        p = (h or "").encode()
        first = best.get(p) is None or (best[p] == i and p not in told)
        told |= {p} if best.get(p) == i else set()
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first else "revisit", None if first else best[p]))
    return sorted(out, key=repr)


def test_archives(spark):
    rows = [(1, "http://a.b/c d\r\ne", "<p>x</p>\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "u", ""), (4, "u", "é日😀" * 40_000), (5, "v", "é日😀" * 40_000),
            (6, "w", "same"), (7, "w", "same"), (7, "w", "same"), (None, "n", "same"), (None, None, "alone"), (None, None, "alone"), (None, "y", "alone"),
            (9, "r", "twice"), (9, "r", "twice"), (9, None, "twice"), (9, "", "twice"), (9, "s", "b" * warc.SEGMENT_BYTES * 2), (9, "s", "b" * warc.SEGMENT_BYTES * 2), (10, None, None), (8, "x", "a" * warc.SEGMENT_BYTES * 2)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, kind string")
    assert rows_of(warc.archive_round_trip(pages)) == facts(rows)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_short_payloads_are_not_revisited(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"), least_bytes=3)
    assert rows_of(warc.read_archives(spark, str(tmp_path / "w"))) == facts(rows, 3)


def test_broken_archives_are_told():
    good = "".join(r + warc.RECORD_END for r in warc.page_records(1, "u", b"x" * 200_000, False, None)).encode()
    heads = [h for h, _ in warc.records(good)]
    assert [h["warc-type"] for h in heads] == ["response", "continuation", "continuation", "continuation"]
    assert heads[-1]["warc-segment-total-length"] == str(sum(len(b) for _, b in warc.records(good)))
    with pytest.raises(ValueError):
        list(warc.records(good[:-10]))
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=300), st.integers(4, 40))
def test_chunks_round_trip(text, size):
    data = text.encode()
    assert b"".join(warc._cuts(data, size)) == data
    assert all(piece.decode() is not None for piece in warc._cuts(data, size))
    assert warc.unchunked(warc.chunked(data)) == data
