"""Collocations and spelling variants against plain versions."""

import random

import numpy as np
import pytest

from equigauge.llm import collocations as mining
from equigauge.llm.collocations import collocations, frequent_phrases
from equigauge.llm.spelling import Filters, near_words, passes_of, spelling_variants

from . import brute
from .brute import rows_of
from .conftest import SCHEMA


def sentences(seed, n):
    """Texts whose words follow one another by habit, with rare ones between."""
    draw = random.Random(seed)
    words = [*(f"w{k}" for k in range(12)), "naïve", "x", "Ünder", "日本"]
    out = []
    for k in range(n):
        text = []
        while len(text) < 40:
            text += draw.choice([["Red", "hot", "chili", "pepper"], ["new", "York"], ["a", "a", "a"], [draw.choice(words)], [f"rare{k}"], ["end", "."], ["one\ntwo"], ["x\ty"]])
        out.append((k, draw.choice(" \t").join(text), draw.choice(["en", "en", "de", None, "und"]), "s", 1))
    return out


@pytest.mark.parametrize(("shards", "top"), [(1, 2000), (3, 2000), (4, 5)])
def test_collocations_agree_with_plain_counts(spark, shards, top):
    rows = sentences(1, 150) + [(None, None, None, None, None), (None, "", "en", None, 1), (7, "new York " * 40, "en", "s", 1), (7, "new York " * 40, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, shard string, n int")
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations(docs, top=top, shards=shards).collect())
    assert got == brute.collocations([(r[2], r[1]) for r in rows], 30, top)


@pytest.mark.parametrize("shards", [1, 2, 3, 5])
def test_phrases_of_a_single_document_are_found(spark, shards):
    """What occurs in one shard alone has its whole cycle, though steps between find nothing."""
    rows = [(k, f"only{k} of{k} here{k} now{k}. " * 30, "en", "s", 1) for k in range(12)] + [(99, "x " * 40, "en", "s", 1)]
    known, _ = frequent_phrases(spark.createDataFrame(rows, SCHEMA), 30, shards)
    want = {(lang, " ".join(p), n) for lang, f in brute.phrases([(r[2], r[1]) for r in rows])[0].items() for p, n in f.items() if n >= 30}
    assert {(r["lang"], r["phrase"], r["n"]) for r in known.collect()} == want and len(want) > 120


def test_full_cells_change_nothing(spark, monkeypatch):
    """With few cells nearly all phrases seem active; every one is still counted in each shard exactly once."""
    rows = sentences(2, 80)
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {(lang, " ".join(p), n) for lang, f in brute.phrases([(r[2], r[1]) for r in rows])[0].items() for p, n in f.items() if n >= 10}
    for cells in (16, 6, 1):
        monkeypatch.setattr(mining, "LEAST_CELLS", cells)
        monkeypatch.setattr(mining, "MOST_CELLS", cells)
        monkeypatch.setattr(mining, "BUCKET_BYTES", 1_000)
        known, _ = frequent_phrases(docs, 10, 3)
        assert {(r["lang"], r["phrase"], r["n"]) for r in known.collect()} == want


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = [r[1].encode() for r in sentences(5, 30)] + [b"x" * 900, b""]
    whole = mining.Phrases(texts, ["en"] * len(texts)).word_hashes()
    monkeypatch.setattr(mining, "BLOCK", 40)
    phrases = mining.Phrases(texts, ["en"] * len(texts))
    assert np.array_equal(phrases.word_hashes(), whole)
    words = b" ".join(texts).lower().replace(b".", b" ").split()
    assert len(set(zip(words, whole.tolist()))) == len(set(words)) == len(set(whole.tolist()))


def test_collocations_of_nothing(spark, odd, odd_rows, empty):
    assert collocations(empty).count() == 0
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations(odd).collect())
    assert got == brute.collocations([(r[2], r[1]) for r in odd_rows], 30, 2000)


def misspelt(seed, n):
    draw = random.Random(seed)
    stems = ["kitchen", "parliament", "señoraría", "aaaaaaaa", "éèêëéèêë", "mississippi"]

    def edit(word):
        k = draw.randrange(len(word))
        return draw.choice([word[:k] + word[k + 1:], word[:k] + draw.choice("abzé÷") + word[k:], word[:k] + draw.choice("abzéÿ") + word[k + 1:]])
    rows = []
    for k in range(n):
        text = []
        for _ in range(30):
            word = draw.choice(stems)
            for _ in range(draw.choice([0, 0, 0, 0, 1, 1, 2])):
                word = edit(word)
            text.append(word.upper() if draw.random() < 0.1 else word)
        rows.append((k, " ".join(text), "n", "root", 1))
    return rows


def test_variants_agree_with_all_pairs(spark):
    rows = misspelt(3, 60) + [(None, "kitchen Kitchen kitchens", None, None, 1), (None, None, None, None, None), (5, "", None, None, 1),
                              (9, "parliament" * 300, None, None, 1), (9, "parliament" * 300, None, None, 1), (1, ("parliament" * 300)[1:] + " x " + ("parliament" * 300)[1:], None, None, 1),
                              (8, "xylophonezz " * 300 + "xylophonezy " * 25 + "xylophonexy " * 2, None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n string, near int")
    got = sorted(tuple(r) for r in spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute.variants([r[:2] for r in rows])
    assert any(r[2] != (r[1] or r[0]) for r in got)  # some root is more than one form away


def test_variants_of_odd_and_no_rows(spark, odd, odd_rows, empty):
    assert spelling_variants(empty).count() == 0
    got = rows_of(spelling_variants(odd))
    assert got == sorted(brute.variants([r[:2] for r in odd_rows]), key=repr)
    with pytest.raises(ValueError, match="more frequent"):
        spelling_variants(odd, ratio=1)


@pytest.mark.parametrize("filter_bytes", [8, 64 << 20])
def test_filters_too_small_or_split_change_nothing(spark, filter_bytes):
    words = sorted({w for r in misspelt(4, 40) for w in r[1].lower().split()})
    near = near_words(spark.createDataFrame([(w, len(w)) for w in words], "word string, n long"), filter_bytes)
    got = {(r["word"], r["near"]) for r in near.collect()}
    plain = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2] for w in words}
    deleted = {w: {w[:k] + w[k + 1:] for k in range(len(w))} for w in words}
    want = {(w, v) for w in words for v in plain[w]
            if (len(v) == len(w) and sum(a != b for a, b in zip(v, w)) == 1) or (len(v) > len(w) and w in deleted[v]) or (len(v) < len(w) and v in deleted[w])}
    assert got == want and near.count() == len(want)


def test_passes_keep_to_their_bytes():
    counts = {7: 1000, 8: 10, 9: 100_000, 400: 1}
    passes = [*passes_of(counts, 4096)]
    assert sorted(k for p in passes for k in p) == sorted(counts)
    assert all(sum(p.values()) * 8 <= 4096 for p in passes) and len(passes) > 1


def test_edits_are_probed_whole_in_parts(monkeypatch):
    from equigauge.llm import spelling
    everything = Filters({k: np.full(1, 2**64 - 1, np.uint64) for k in (6, 7)})
    want = {(0, "zebrañs"[:k] + chr(c) + "zebrañs"[k + 1:]) for k in range(7) for c in spelling.LETTERS.tolist() if c < ord("zebrañs"[k])}
    want |= {(0, "zebrañs"[:k] + "zebrañs"[k + 1:]) for k in range(7)}
    for probes in (1 << 20, 50):
        monkeypatch.setattr(spelling, "PROBES", probes)
        found = [*everything.edits(["zebrañs"])]
        assert set(found) == want and len(found) == len(want)
