"""Spelling variants: neighbours at one edit, found by probing generated edits in Bloom filters.

The vocabulary is counted with DataFrame functions. One blocked Bloom filter per word length is sent out; a word's edits
are probed as hashes, which follow from the word's own hash without writing the edit, and only edits that the filter
does not rule out are written and joined with the vocabulary, which removes the false positives. Of two words that
differ in one letter, the one with the later letter finds the other; of two that differ by a missing letter, the longer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.caches import cache_of
from equigauge.llm.text import whole
from equigauge.session import settle

#: The letters that words are made of, in order of code points.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
_RANK = np.zeros(256, np.int64)
_RANK[LETTERS.astype(np.int64)] = np.arange(len(LETTERS))
#: Bits of a filter per word, bits that a word sets, and bytes of filters that a task holds at once, at most.
WORD_BITS, SET_BITS = 24, 5
FILTER_BYTES = 64 << 20
#: Blocks of 64 bits that one task builds, and edits that are probed at once.
BUILT_BLOCKS, PROBES = 1 << 16, 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = np.uint64(pow(_BASE, -1, 2**64))


def vocabulary(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """(word, n) of the words of `docs` (doc_id, text) with at least `shortest` letters that occur `least` times.

    Words are runs of letters a-z, A-Z in lower case, and U+00C0 to U+00FF. Where the CRC-32 of `<doc_id>:<word>`, NULL
    ids as nothing, is divisible by `every`, the letter at its remainder by the length is left out.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(whole(), F.lit(f"[A-Za-zÀ-ÿ]{{{shortest},}}+"), F.lit(0))).alias("run"))
    lowered = runs.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    summed = lowered.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.expr("cast(h % length(run) AS int)")
    word = F.when(F.col("h") % every == 0, F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))
    return summed.select(word.alias("word")).filter(F.length("word") >= shortest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _mixed(h: np.ndarray, length: int) -> np.ndarray:
    h = h + np.uint64((length * 0xD6E8FEB86659FD93) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Words of one length: the length, their places in `words`, and their letters, a row each, in rows of bounded size."""
    sizes = np.array([len(w) for w in words], np.int64)
    for length in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == length)
        step = max(1, PROBES // (len(LETTERS) * length))
        for k in range(0, len(places), step):
            mine = places[k:k + step]
            yield length, mine, np.array([words[i] for i in mine], f"U{length}").view(np.uint32).reshape(len(mine), length).astype(np.uint64)


def _masks(h: np.ndarray) -> np.ndarray:
    """The bits of a block that a hash sets."""
    out = np.zeros(len(h), np.uint64)
    for k in range(SET_BITS):
        out |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return out


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(30)) % np.uint64(blocks)).astype(np.int64)


class Filters:
    """Blocked Bloom filters by word length."""

    def __init__(self, filters: dict[int, np.ndarray]):
        self.filters = filters

    def perhaps(self, h: np.ndarray, length: int) -> np.ndarray:
        """Places of the hashes of words of this length that the filter does not rule out."""
        blocks = self.filters[length]
        mask = _masks(h)
        return np.flatnonzero(blocks[_block(h, len(blocks))] & mask == mask)

    def edits(self, words: list[str]) -> Iterator[tuple[int, str]]:
        """Place of a word, and an edit of it that may be a word."""
        for length, places, letters in _by_length(words):
            power = _powers(length + 1)
            prefix = np.concatenate([np.zeros((len(letters), 1), np.uint64), np.cumsum(letters * power[:length], axis=1)], axis=1)
            total = prefix[:, -1]
            if length in self.filters:
                yield from self._replaced(words, places, letters, total, power)
            if length - 1 in self.filters:
                rest = prefix[:, :-1] + (total[:, None] - prefix[:, 1:]) * _BACK
                first_of_run = np.concatenate([np.ones((len(letters), 1), bool), letters[:, 1:] != letters[:, :-1]], axis=1)
                row, at = np.nonzero(first_of_run)
                for k in self.perhaps(_mixed(rest[row, at], length - 1), length - 1).tolist():
                    place, i = int(places[row[k]]), int(at[k])
                    yield place, words[place][:i] + words[place][i + 1:]

    def _replaced(self, words: list[str], places: np.ndarray, letters: np.ndarray, total: np.ndarray, power: np.ndarray) -> Iterator[tuple[int, str]]:
        length = letters.shape[1]
        ranks = _RANK[letters.astype(np.int64)].ravel()
        ends = np.cumsum(ranks)
        a = 0
        while a < len(ranks):  # a very long word is taken by parts
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PROBES, "right")))
            of = np.repeat(np.arange(a, b), ranks[a:b])
            letter = np.arange(len(of)) - np.repeat(ends[a:b] - ranks[a:b] - (ends[a - 1] if a else 0), ranks[a:b])
            row, at = of // length, of % length
            h = total[row] + (LETTERS[letter] - letters[row, at]) * power[at]
            for k in self.perhaps(_mixed(h, length), length).tolist():
                place, i = int(places[row[k]]), int(at[k])
                yield place, words[place][:i] + chr(int(LETTERS[letter[k]])) + words[place][i + 1:]
            a = b


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for length, places, letters in _by_length(batch["word"].to_pylist()):
            h = _mixed((letters * _powers(length)).sum(axis=1, dtype=np.uint64), length)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), length, np.int32)), pa.array(h.view(np.int64))], ["length", "hash"])


def _built(blocks_of):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        length, chunk = int(part["length"].iloc[0]), int(part["chunk"].iloc[0])
        h = part["hash"].to_numpy(np.int64).view(np.uint64)
        out = np.zeros(min(BUILT_BLOCKS, blocks_of[length] - chunk * BUILT_BLOCKS), np.uint64)
        np.bitwise_or.at(out, _block(h, blocks_of[length]) - chunk * BUILT_BLOCKS, _masks(h))
        return pd.DataFrame({"length": [length], "chunk": [chunk], "bits": [out.tobytes()]})
    return run


def build_filters(words: DataFrame, blocks_of: dict[int, int]) -> Filters:
    """Filters of `words` (word) whose length is in `blocks_of`, with so many blocks each. The driver gets the bits alone."""
    known = F.create_map([F.lit(x) for pair in blocks_of.items() for x in pair])
    hashed = words.filter(F.length("word").isin([*blocks_of])).mapInArrow(_hashed, "length int, hash long")
    block = F.pmod(F.shiftrightunsigned("hash", 30), known[F.col("length")])
    rows = hashed.withColumn("chunk", F.floor(block / BUILT_BLOCKS).cast("int")).groupBy("length", "chunk").applyInPandas(
        _built(blocks_of), "length int, chunk int, bits binary").toLocalIterator()
    filters = {length: np.zeros(n, np.uint64) for length, n in blocks_of.items()}
    for row in rows:
        bits = np.frombuffer(row["bits"], np.uint64)
        filters[row["length"]][row["chunk"] * BUILT_BLOCKS:][:len(bits)] = bits
    return Filters(filters)


def _probed(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_of("spelling")
        for batch in batches:
            words = batch["word"].to_pylist()
            found = [*sent.value.edits(words)]
            take = pa.array([place for place, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["word"].take(take), batch["n"].take(take), pa.array([edit for _, edit in found], pa.string())], ["word", "n", "edit"])
    return run


def passes_of(counts: dict[int, int], most_bytes: int) -> Iterator[dict[int, int]]:
    """Blocks per length, in passes whose filters have at most `most_bytes` together.

    A filter has `WORD_BITS` bits per word; one that would need more than `most_bytes` gets that much, and lets more
    edits through to the join.
    """
    out: dict[int, int] = {}
    for length, n in sorted(counts.items()):
        blocks = min(max(1, n * WORD_BITS // 64), most_bytes // 8)
        if out and (sum(out.values()) + blocks) * 8 > most_bytes:
            yield out
            out = {}
        out[length] = blocks
    if out:
        yield out


def near_words(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, near, near_n), both ways, of all pairs of `words` (word, n; distinct) that are one edit apart."""
    context = words.sparkSession.sparkContext
    counts = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    perhaps = None
    for blocks_of in passes_of(counts, filter_bytes):
        sent = context.broadcast(build_filters(words, blocks_of))
        sources = words.filter(F.length("word").isin(sorted({*blocks_of, *(k + 1 for k in blocks_of)})))
        found = sources.mapInArrow(_probed(sent), "word string, n long, edit string")
        perhaps = found if perhaps is None else perhaps.union(found)
    if perhaps is None:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    pairs = perhaps.join(words.toDF("edit", "edit_n"), "edit")
    both = F.explode(F.array(F.struct("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")),
                             F.struct(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return pairs.select(both.alias("pair")).select("pair.*")


def with_roots(named: DataFrame, ratio: int) -> DataFrame:
    """`named` (word, form, n, ...) and the root that forms lead to. A form occurs at least `ratio` times as often."""
    most = named.agg(F.max("n")).first()[0] or 1
    steps = 1 + int(math.log(most) / math.log(ratio))
    reached = named.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    for _ in range(max(1, math.ceil(math.log2(steps + 1)))):
        reached = settle(reached)
        ahead = reached.select(F.col("word").alias("to"), F.col("to").alias("beyond"))
        reached = reached.join(ahead, "to", "left").select("word", F.coalesce("beyond", "to").alias("to"))
    return named.join(reached, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")


def spelling_variants(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of `docs` (doc_id, text) that `vocabulary` keeps.

    Near words are one inserted, left out or replaced letter apart. A word's form is its most frequent near word, of ties
    the least in order of code points, if that occurs at least `ratio` times as often, else NULL; its root is the last of
    the forms that follow from it, or the word itself. NULL and empty texts have no words; repeated rows count each time;
    a NULL doc_id is written as nothing. Words may be of any length. An empty table gives no rows; other columns are
    ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its variants")
    words = settle(vocabulary(docs, shortest, least, every))
    near = near_words(words)
    rows = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")).union(
        near.select("word", F.lit(None).cast("long"), "near", "near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    told = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    follows = form_n >= ratio * F.col("n")
    named = settle(told.select("word", F.when(follows, F.col("best.near")).alias("form"), "n", "n_near", F.when(follows, form_n).alias("form_n")))
    return with_roots(named, ratio).select("word", "form", "root", "n", "n_near", "form_n")
