"""Packing token sequences: concatenate all documents and cut at fixed lengths.

First pass: every task tokenizes its documents once and stores the ids with their place inside the task's partition.
Prefix sums over the partition totals turn those into places in the whole. Second pass: every document is cut where it
crosses a window border; a document that does leaves a piece on both sides.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equigauge.llm.caches import cache_of
from equigauge.llm.text import whole
from equigauge.session import settle

#: The id that ends every document.
END = 1
#: Entries a worker keeps of whitespace-separated chunks and of lower-case words.
CHUNKS, WORDS = 300_000, 500_000
#: Documents of one output batch.
BATCH = 512
_plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
_latin = re.compile(r"[a-zß-öø-ÿ]+")


class ChunkIds(dict):
    """Ids of chunks of text that hold no blank and no line feed, as bytes of little-endian 16-bit numbers.

    The tokenizer splits at white space first and lower-cases letters, so a chunk's ids do not depend on its neighbours,
    and a Latin word with a sign behind it has the ids of the word in lower case, then those of the sign.
    """

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel
        super().__init__()
        self.tokenizer, self.words = tokenizer, {}
        self.merge = tokenizer.model.tokenize
        written = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: written(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def encoded(self, text: str) -> bytes:
        """A word of small Latin letters is one pre-token in normal form, so the merges alone give its ids."""
        if _latin.fullmatch(text):
            return np.array([t.id for t in self.merge(text.translate(self.letters))], "<u2").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def word(self, text: str) -> bytes:
        ids = self.words.get(text)
        if ids is None:
            ids = self.encoded(text)
            if len(self.words) < WORDS:
                self.words[text] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        m = _plain.fullmatch(chunk)
        if m:
            ids = self.word(m[1].lower()) + (self.word(m[2]) if m[2] else b"")
        else:
            ids = self.word(chunk) if chunk else b""
        if len(self) < CHUNKS:
            self[chunk] = ids
        return ids


def _chunks(path: str) -> ChunkIds:
    held = cache_of("packing")
    if path not in held:
        from tokenizers import Tokenizer
        held[path] = ChunkIds(Tokenizer.from_file(path))
    return held[path]


def token_bytes(text: str, path: str) -> bytes:
    """The ids of a whole text without the end id."""
    return b"".join(map(_chunks(path).__getitem__, text.replace("\n", " ").split(" ")))


def _tokenized(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                piece = batch.slice(k, BATCH)
                ids = [token_bytes(x, path) + end for x in piece["text"].to_pylist()]
                sizes = np.array([len(x) // 2 for x in ids], np.int64)
                ends = at + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), piece["doc_id"], pa.array(ends - sizes), pa.array(sizes), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "inside", "doc_tokens", "ids"])
                at = int(ends[-1])
    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_of("packing_cut")  # the ids are stored; their caches are not needed again
        for batch in batches:
            rows: list[tuple] = []
            for doc, first, raw in zip(batch["doc_id"].to_pylist(), batch["first"].to_pylist(), batch["ids"].to_pylist()):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                start = 0
                while start < len(ids):
                    at = first + start
                    n = min(len(ids) - start, length - at % length)
                    rows.append((doc, start, n, zlib.crc32(ids[start:start + n]), len(ids), at // length, at % length))
                    start += n
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], PIECE)
    return run


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer: str, length: int = 2048) -> DataFrame:
    """The pieces of `docs` (doc_id, text) in sequences of `length` ids: `PIECE`, all long.

    `tokenizer` is the path of a tokenizers file with fewer than 65,536 ids that drops white space and lower-cases. NULL
    text counts as empty and gives the end id alone. All sequences are full but the last, so padding is less than one
    sequence. A doc_id may be NULL or repeated; every row is packed for itself. An empty table gives no rows; other
    columns are ignored. The order is that of the stored partitions; no row is moved. The table of partition totals has
    one row per partition of the first pass, which bounds what is broadcast.
    """
    stored = settle(docs.select("doc_id", whole().alias("text")).mapInArrow(
        _tokenized(tokenizer), "part int, doc_id long, inside long, doc_tokens long, ids binary"))
    totals = stored.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    placed = stored.join(F.broadcast(offsets), "part").select("doc_id", (F.col("before") + F.col("inside")).alias("first"), "ids")
    return placed.mapInArrow(_cut(length), ", ".join(f"{c} long" for c in PIECE))
