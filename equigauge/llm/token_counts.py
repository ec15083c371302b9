"""Token counts by a two-tier lookup inside the tasks that read the texts.

A text is split into pre-tokens by the tokenizer's own pattern. The first tier is a table of the lengths of frequent
pre-tokens, sent to every worker once; the second is a cache that each worker fills as it meets others, encoding all new
ones of a batch of documents in one call. No pre-token is ever shuffled.
"""

from __future__ import annotations

import itertools
import os
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.llm.caches import cache_of
from equigauge.llm.text import whole

#: The split of byte-level tokenizers, and the string they keep as one special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"
#: Documents sampled to find frequent pre-tokens, entries of the table sent out, entries a worker may add to its cache.
SAMPLE_ROWS, FREQUENT, CACHED = 2_000, 65_536, 400_000
#: Code points of text whose new pre-tokens are encoded in one call.
CHUNK = 1 << 20

_split = regex.compile(PATTERN).findall


class Lengths:
    """Number of tokens of texts. `table` has the lengths of frequent pre-tokens."""

    def __init__(self, path: str, table: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.encode = Tokenizer.from_file(path).encode_batch_fast
        self.table, self.cache = table, {}

    def _new(self, words: list[str]) -> dict[str, int]:
        return dict(zip(words, map(len, self.encode(words, add_special_tokens=False))))

    def many(self, texts: list[str]) -> list[int]:
        lists, specials = [], []
        for text in texts:
            parts = text.split(SPECIAL)
            specials.append(len(parts) - 1)
            lists.append(_split(text) if len(parts) == 1 else [w for part in parts for w in _split(part)])
        table, cache = self.table, self.cache
        new = self._new(list({w for w in itertools.chain.from_iterable(lists) if w not in table and w not in cache}))
        if len(cache) + len(new) <= CACHED:
            cache.update(new)
        out = []
        for words, special in zip(lists, specials):
            n = special
            for w in words:
                k = table.get(w)
                if k is None:
                    k = cache.get(w)
                    if k is None:
                        k = new[w]
                n += k
            out.append(n)
        return out


def _counts(path: str, sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, sent.id)
        held = cache_of("token_counts")
        if key not in held:
            held.clear()
            held[key] = Lengths(path, sent.table())
        worker = held[key]
        for batch in batches:
            texts = batch["text"].to_pylist()
            out: list[int] = []
            while len(out) < len(texts):
                size = at = 0
                for text in itertools.islice(texts, len(out), None):
                    at += 1
                    size += len(text)
                    if size >= CHUNK:
                        break
                out += worker.many(texts[len(out):len(out) + at])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(out, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])
    return run


class _Sent:
    """The table of frequent lengths as one broadcast string of words and one of lengths."""

    def __init__(self, spark: SparkSession, table: dict[str, int]):
        self.value = spark.sparkContext.broadcast(("\0".join(table), bytes(min(n, 255) for n in table.values())))
        self.id = uuid.uuid4().hex

    def table(self) -> dict[str, int]:
        words, lengths = self.value.value
        return dict(zip(words.split("\0"), lengths)) if lengths else {}


def _sampled_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch["text"].to_pylist():
            seen.update(w for part in text.split(SPECIAL) for w in _split(part))
    common = [(w, n) for w, n in seen.most_common(FREQUENT) if "\0" not in w and n > 1]
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in common], pa.string()), pa.array([n for _, n in common], pa.int64())], ["word", "n"])


def frequent_lengths(docs: DataFrame, tokenizer: str, rows: int = SAMPLE_ROWS) -> dict[str, int]:
    """Lengths of at most `FREQUENT` pre-tokens that are common in about `rows` documents drawn from all.

    The sample only decides what the first tier holds, which moves time between the tiers and never a count.
    """
    n = docs.count()
    drawn = docs if n <= rows else docs.sample(rows / n, seed=11)
    words = drawn.mapInArrow(_sampled_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    common = [r["word"] for r in words.orderBy(F.desc("n"), "word").limit(FREQUENT).toLocalIterator()]
    return {w: n for w, n in Lengths(tokenizer, {})._new(common).items() if n < 255}


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of `docs` (doc_id, text).

    `tokenizer` is the path of a byte-level tokenizers file. NULL text counts as empty: no bytes, no tokens. The special
    string inside a text is one token, as the library has it. Rows may repeat and doc_id may be NULL; an empty table
    gives no rows; other columns are ignored.
    """
    texts = docs.select("doc_id", whole().alias("text"))
    sent = _Sent(docs.sparkSession, frequent_lengths(texts.select("text"), tokenizer))
    return texts.mapInArrow(_counts(tokenizer, sent), "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
