"""Toxicity from document labels by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in the weights of its words and of their first
letters; weights are evidence for toxicity only, never below zero, and shrink unless the labels hold them up; a document
is toxic if any sentence is, so its score is the noisy-or of them. Document labels alone train it: the gradient reaches
the sentences that carry the label, and the same probabilities later point to the offending ones.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.llm.caches import cache_of
from equigauge.llm.text import whole

#: Labelled documents, and bytes of text, the classifier is fitted on at most; features it keeps at most, and how many
#: documents must have one.
TRAIN_ROWS, TRAIN_BYTES, FEATURES, LEAST_DOCUMENTS = 8_192, 64 << 20, 65_536, 5
#: Lengths of the word starts that are features beside the word.
STARTS = (4, 5)
ROUNDS, RATE, SHRINK, FIRST_BIAS = 60, 0.3, 0.01, -11.0
THRESHOLD, SENTENCE_THRESHOLD = 0.3, 0.3
CACHED = 400_000
#: Code points of text scored at once.
CHUNK = 1 << 20
HELD_OUT = 2

_tokens = re.compile(r"[^\W\d_]+|[.!?\n]+").findall
_sentence = re.compile(r"[^.!?\n]+")


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}^" for n in STARTS if len(word) >= n)]


def _layout(texts: list[str], value) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words' values, the sentence of each, and the document of each sentence. `value` maps a word; ends map to None."""
    values: list = []
    cuts, owners = [0], []
    for k, text in enumerate(texts):
        ended = True
        for t in _tokens(text.lower()):
            if t[0] in ".!?\n":
                ended = True
                continue
            if ended:
                cuts.append(len(values))
                owners.append(k)
                ended = False
            values.append(value(t))
    sizes = np.diff([*cuts[1:], len(values)]) if owners else np.zeros(0, np.int64)
    return np.array(values), np.repeat(np.arange(len(owners)), sizes), np.array(owners, np.int64)


def _none_toxic(z: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Log probability that no sentence is toxic, per document."""
    return -np.bincount(owners, weights=np.logaddexp(0.0, z), minlength=n)


def fit(texts: list[str], toxic: np.ndarray) -> dict[str, float]:
    """Weights by feature, the bias under the empty string."""
    if not len(toxic) or toxic.min() == toxic.max():
        return {"": 20.0 if len(toxic) and toxic.max() else -20.0}
    index: dict[str, int] = {}
    words, sentences, owners = _layout(texts, lambda w: index.setdefault(w, len(index)))
    vocabulary = list(index)
    documents: Counter[str] = Counter()
    seen = np.unique(owners[sentences] * len(index) + words) if len(words) else np.zeros(0, np.int64)
    per_word = np.bincount(seen % len(index), minlength=len(index)) if len(index) else np.zeros(0)
    for w, n in zip(vocabulary, per_word.tolist()):
        for f in word_features(w):
            documents[f] += n
    features = [f for f, n in documents.most_common(FEATURES) if n >= LEAST_DOCUMENTS]
    number = {f: k for k, f in enumerate(features)}
    pairs = [(k, number[f]) for k, w in enumerate(vocabulary) for f in word_features(w) if f in number]
    of_word, of_feature = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    weight, bias = np.zeros(len(features)), FIRST_BIAS
    mean, square = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for turn in range(1, ROUNDS + 1):
        by_word = np.bincount(of_word, weights=weight[of_feature], minlength=len(vocabulary))
        z = bias + np.bincount(sentences, weights=by_word[words], minlength=len(owners))
        clean = _none_toxic(z, owners, len(texts))
        pull = np.where(toxic > 0, -1.0 / np.expm1(np.clip(-clean, 1e-9, 700.0)), 1.0)
        slope = pull[owners] * np.exp(-np.logaddexp(0.0, -z)) / len(texts)
        to_word = np.bincount(words, weights=slope[sentences], minlength=len(vocabulary))
        step = np.append(np.bincount(of_feature, weights=to_word[of_word], minlength=len(features)), slope.sum())
        mean, square = 0.9 * mean + 0.1 * step, 0.99 * square + 0.01 * step**2
        move = RATE * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        weight, bias = np.maximum(weight - move[:-1] - SHRINK, 0.0), bias - move[-1]
    return {"": float(bias), **{f: float(w) for f, w in zip(features, weight) if abs(w) > 1e-4}}


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> dict[str, float]:
    """The weights fitted on at most `rows` labelled documents, drawn by a hash of their id from all but the held-out ones.

    Of these, one text per id, the shortest, is taken in the order of that hash while all have at most `most_bytes`
    together. Both bounds hold before anything is gathered, so the one task that fits the weights, and the weights that
    reach the driver, are of a fixed size. A doc_id with several labels counts as toxic if any says so; NULL labels and ids
    count as none.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("of")).agg(F.max("toxic").alias("toxic"))
    drawn = known.filter(~held_out("of")).orderBy(F.xxhash64("of"), "of").limit(rows)
    bags = docs.select("doc_id", whole().alias("text")).join(F.broadcast(drawn), F.col("doc_id") == F.col("of")).groupBy("of").agg(
        F.max("toxic").alias("toxic"), F.min(F.struct(F.octet_length("text").alias("size"), "text")).alias("least"))
    # At most `rows` rows.
    upto = F.sum("least.size").over(Window.orderBy(F.xxhash64("of"), "of"))
    taken = bags.withColumn("upto", upto).filter(F.col("upto") <= most_bytes)

    def fitted(bags: pd.DataFrame) -> pd.DataFrame:
        cache_of("toxicity").clear()  # the fit needs the room
        bags = bags.sort_values(["of", "text"])
        return pd.DataFrame(fit(bags["text"].tolist(), bags["toxic"].to_numpy()).items(), columns=["feature", "weight"])

    together = taken.select("of", "toxic", "least.text", F.lit(True).alias("all")).groupBy("all")
    return {r["feature"]: r["weight"] for r in together.applyInPandas(fitted, "feature string, weight double").collect()} or {"": -20.0}


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


class WordScores(dict):
    """Sum of the weights of a word's features, kept for words met before."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        score = sum(self.weights.get(f, 0.0) for f in word_features(word))
        if len(self) < CACHED:
            self[word] = score
        return score


def scored(texts: list[str], words: WordScores, bias: float) -> tuple[np.ndarray, list[str]]:
    """Score of every text and its offending sentences as start:end in code points, for texts at the threshold."""
    values, sentences, owners = _layout(texts, words.__getitem__)
    z = bias + np.bincount(sentences, weights=values, minlength=len(owners)) if len(owners) else np.zeros(0)
    scores = -np.expm1(_none_toxic(z, owners, len(texts)))
    places = [""] * len(texts)
    for k in np.flatnonzero(scores >= THRESHOLD).tolist():
        found = []
        for m in _sentence.finditer(texts[k]):
            logit = bias + sum(words[t] for t in _tokens(m[0].lower()))
            if np.exp(-np.logaddexp(0.0, -logit)) >= SENTENCE_THRESHOLD:
                found.append(f"{m.start()}:{m.end()}")
        places[k] = ",".join(found)
    return scores, places


def with_scores(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """`docs` with toxicity_score (0 to 1) and toxicity_sentences, all other columns as they are.

    Columns of these names in `docs` are an error.
    """
    if {"toxicity_score", "toxicity_sentences"} & set(docs.columns):
        raise ValueError("the table has a toxicity_score or toxicity_sentences already")
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    mark, column = uuid.uuid4().hex, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = cache_of("toxicity")
        if mark not in held:
            held.clear()
            held[mark] = WordScores(sent.value)
        words, bias = held[mark], sent.value[""]
        for batch in batches:
            texts = [t or "" for t in batch.column(column).to_pylist()]
            scores, places, at = [], [], 0
            while at < len(texts):
                ends = itertools.accumulate(map(len, itertools.islice(texts, at, None)))
                n = next((k for k, size in enumerate(ends, 1) if size >= CHUNK), len(texts) - at)
                s, p = scored(texts[at:at + n], words, bias)
                scores.append(s)
                places += p
                at += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64()), pa.array(places, pa.string())],
                [*batch.schema.names, "toxicity_score", "toxicity_sentences"])

    more = [T.StructField("toxicity_score", T.DoubleType()), T.StructField("toxicity_sentences", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, offending for every row of `docs` (doc_id, text).

    `labels` has doc_id and toxic; held-out documents take no part in the fit, whose only inputs are words. NULL and
    empty texts score 0. A NULL doc_id is not held out. Without labels of both classes the score is about 0 or 1 for any
    text that has words. `offending` lists sentences as start:end in code points. Rows may repeat; an empty table gives no
    rows; other columns are ignored.
    """
    texts = docs.select("doc_id", "text")
    return with_scores(texts, train(texts, labels)).select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"), F.col("toxicity_sentences").alias("offending"))
