"""Benchmark decontamination: an FM-index per shard of the corpus, searched for the windows of all benchmark items.

First pass: every task numbers the words of its documents and builds an FM-index per shard, a few megabytes of text; the
shards are stored. A document longer than a shard lies in several that overlap by one word less than a window. Second
pass, for each block of the benchmark: the block's distinct windows are sought backwards in every shard, through the
ranks of its wavelet matrix; rows of those that occur are stepped to sampled places, and overlapping finds become spans.
The spans and items of a document are then merged over its shards and the blocks. Stored shards can be searched again
for another benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.llm.caches import cache_of
from equigauge.llm.fm_index import FMIndex, binary_array
from equigauge.llm.text import whole
from equigauge.session import settle

#: Bytes of text, words and documents of a shard, at most, but for the text that reaches the limit.
SHARD_BYTES, SHARD_WORDS, SHARD_ROWS = 4 << 20, 1 << 20, 8_192
#: Words of a block of the benchmark; a block is what a task holds and what is sent out at once.
BLOCK_WORDS = 1 << 18
WINDOW = 10
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
PIECE = np.dtype([("row", "<i8"), ("from", "<i8"), ("words", "<i8")])
_STORED = "pieces binary, lengths binary, letters binary, counts binary, levels int, planes binary, marks binary, sampled binary"


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, how many each text has, and where each word begins and ends among the joined texts.

    Words are runs of digits, of letters a-z in lower case and of all that is not ASCII. Texts are joined by one byte.
    """
    data = _FOLD[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    inside = _IN_WORD[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    borders = np.cumsum([0, *(len(t) + 1 for t in texts)])
    sizes = np.diff(np.searchsorted(starts, borders))
    return binary_array(ends - starts, data[inside]), sizes, starts, ends


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Rows of a batch by and by, with the place of the first."""
    at, held, size = 0, [], 0
    for text in batch["bytes"].to_pylist():
        held.append(text)
        size += len(text)
        if size >= SHARD_BYTES or len(held) >= SHARD_ROWS:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def _shards_of(words: pa.Array, sizes: np.ndarray, row: int, overlap: int, shard_words: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Pieces of documents, and their words, that make a shard of at most `shard_words` words and the overlap.

    A piece that another one of its document follows fills its shard, so pieces of a shard never overlap.
    """
    pieces, first = [], 0
    for k, size in enumerate(sizes.tolist()):
        for at in range(0, max(size - overlap, 1), shard_words):
            pieces.append((row + k, at, min(size, at + shard_words + overlap) - at, first + at))
        first += size
    a = held = 0
    for b, piece in enumerate(pieces):
        if held and held + piece[2] > shard_words + overlap:
            yield _shard(words, pieces[a:b])
            a, held = b, 0
        held += piece[2]
    yield _shard(words, pieces[a:])


def _shard(words: pa.Array, pieces: list[tuple]) -> tuple[np.ndarray, pa.Array]:
    first, last = pieces[0][3], pieces[-1][3] + pieces[-1][2]
    return np.array([p[:3] for p in pieces], PIECE), words.slice(first, last - first)


def _indexed(overlap: int, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_of("decontamination")
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, texts in _groups(batch):
                words, sizes, _, _ = split_words(texts)
                told = [(np.arange(row, row + len(texts)), batch["doc_id"].slice(at, len(texts)), sizes)]
                for pieces, part in _shards_of(words, sizes, row, overlap, shard_words):
                    rows, ids, counts = told.pop() if told else (row + np.zeros(0, np.int64), batch["doc_id"].slice(0, 0), np.zeros(0, np.int64))
                    columns = FMIndex.build(part, pieces["words"]).stored() | {"pieces": pieces.tobytes()}
                    ends = pa.array([0, len(rows)], pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        *(pa.ListArray.from_arrays(ends, x) for x in (pa.array(rows), ids, pa.array(counts.astype(np.int64)))),
                        *(pa.array([columns[c]], pa.int32() if c == "levels" else pa.binary()) for c in _names())], ["rows", "ids", "sizes", *_names()])
                row += len(texts)
    return run


def _names() -> list[str]:
    return [c.split(" ")[0] for c in _STORED.split(", ")]


def index_shards(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Stored FM-indexes of `docs` (doc_id, text), for windows of at most `window` words.

    A row per shard: the documents that begin in it (rows, ids, sizes), the pieces of documents in it, and the index.
    """
    kind = docs.schema["doc_id"].dataType
    lists = [T.StructField("rows", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(kind)), T.StructField("sizes", T.ArrayType(T.LongType()))]
    rows = docs.select("doc_id", whole().cast("binary").alias("bytes"))
    stored = T.StructType.fromDDL(_STORED)
    return settle(rows.mapInArrow(_indexed(window - 1, shard_words), T.StructType([*lists, *stored.fields])))


class Block:
    """Windows of items: distinct ones by length, as places in `words`, with the items that have them."""

    def __init__(self, held: list[tuple[str, pa.Array]], window: int):
        self.items = [item for item, _ in held]
        coded = pa.concat_arrays([w for _, w in held]).dictionary_encode()
        self.words, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        by_length: dict[int, tuple[list, list]] = {}
        at = 0
        for k, (_, w) in enumerate(held):
            mine = ids[at:at + len(w)]
            at += len(w)
            if len(mine):
                windows = np.lib.stride_tricks.sliding_window_view(mine, min(window, len(mine)))
                rows, owners = by_length.setdefault(windows.shape[1], ([], []))
                rows.append(windows)
                owners.append(np.full(len(windows), k))
        self.windows = []
        for rows, owners in by_length.values():
            distinct, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
            owner = np.concatenate(owners)
            order = np.argsort(which, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(distinct)))])
            self.windows.append((distinct, owner[order], ends))

    def __getstate__(self) -> dict:
        lengths = pc.binary_length(self.words).to_numpy()
        return self.__dict__ | {"words": (lengths, b"".join(self.words.to_pylist()))}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state | {"words": binary_array(*state["words"])}


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items of `benchmark` (item_id, text) in blocks of about `block_words` words; the driver holds one at a time.

    Longer items lie in several blocks and overlap there by one word less than a window.
    """
    held, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), whole().cast("binary").alias("bytes"))
    for row in rows.toLocalIterator():
        words = split_words([bytes(row["bytes"])])[0]
        for at in range(0, max(1, len(words) - window + 1), block_words):
            held.append((row["item"], words.slice(at, block_words + window - 1)))
            size += len(held[-1][1])
            if size >= block_words:
                yield Block(held, window)
                held, size = [], 0
    if size:
        yield Block(held, window)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each low to its high, and which range they are of."""
    sizes = high - low
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of], of


def finds(index: FMIndex, pieces: np.ndarray, block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every piece in which windows occur: its place, starts and ends of its spans in the document, and its items."""
    known = index.numbers(block.words)
    places, lengths, owners, of_piece = [], [], [], []
    begins = np.cumsum(pieces["words"] + 1) - pieces["words"] - 1
    for windows, items, ends in block.windows:
        which, low, high = index.search(known[windows])
        rows, of = _ranges(low, high)
        at = index.locate(rows)
        piece = np.searchsorted(begins, at, "right") - 1
        places.append(at)
        lengths.append(np.full(len(at), windows.shape[1]))
        pairs = np.unique(piece * len(windows) + which[of])
        entry, mine = _ranges(ends[pairs % len(windows)], ends[pairs % len(windows) + 1])
        both = np.unique((pairs // len(windows))[mine] * len(block.items) + items[entry])
        owners.append(both % len(block.items))
        of_piece.append(both // len(block.items))
    if not sum(map(len, places)):
        return
    at, length = np.concatenate(places), np.concatenate(lengths)
    change = np.zeros(int(pieces["words"].sum()) + len(pieces) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + length, -1)
    edge = np.flatnonzero(np.diff(np.cumsum(change) > 0, prepend=False))
    starts, ends = edge[::2], edge[1::2]
    span_of = np.searchsorted(begins, starts, "right") - 1
    owner, of = np.concatenate(owners), np.concatenate(of_piece)
    order = np.argsort(of, kind="stable")
    owner, of = owner[order], of[order]
    for k in np.unique(span_of):
        a, b = np.searchsorted(span_of, [k, k + 1])
        c, d = np.searchsorted(of, [k, k + 1])
        shift = pieces["from"][k] - begins[k]
        yield int(k), starts[a:b] + shift, ends[a:b] + shift, owner[c:d]


def _searched(block: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_of("decontamination")
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                pieces = np.frombuffer(row["pieces"], PIECE)
                out = [(int(pieces["row"][p]), [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())], [block.value.items[i] for i in items.tolist()])
                       for p, starts, ends, items in finds(FMIndex.loaded(row), pieces, block.value)]
                if out:
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["row", "spans", "items"]), schema=_FOUND, preserve_index=False)
    return run


_SPANS = "array<struct<start: long, end: long>>"
_FOUND = pa.schema([("row", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])


def _merged(spans: pd.Series) -> pd.Series:
    """Spans in order, with those that meet made one."""
    out = []
    for found in spans:
        if len(found) > 1:
            start, end = np.array(sorted((s["start"], s["end"]) for s in found)).T
            end = np.maximum.accumulate(end)
            new = np.append(True, start[1:] > end[:-1])
            found = [{"start": a, "end": b} for a, b in zip(start[new].tolist(), end[np.append(new[1:], True)].tolist())]
        out.append(found)
    return pd.Series(out, dtype=object)


def search_shards(shards: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, spans (word positions, end exclusive) and items (sorted) of every document in stored shards."""
    context = shards.sparkSession.sparkContext
    told = shards.select(F.explode(F.arrays_zip("rows", "ids", "sizes")).alias("doc")).select(
        F.col("doc.rows").alias("row"), F.col("doc.ids").alias("doc_id"), F.col("doc.sizes").alias("n_words"))
    out = told.withColumns({"spans": F.lit(None).cast(_SPANS), "items": F.lit(None).cast("array<string>")})
    names = _names()
    for block in benchmark_blocks(benchmark, window, block_words):
        found = shards.select(*names).mapInArrow(_searched(context.broadcast(block)), f"row long, spans {_SPANS}, items array<string>")
        out = out.unionByName(found, allowMissingColumns=True)
    whole_of = out.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.first(F.when(F.col("n_words").isNotNull(), F.struct("doc_id")), ignorenulls=True).alias("named"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return whole_of.select("named.doc_id", "n_words", F.pandas_udf(_merged, _SPANS)("spans").alias("spans"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans and items for every row of `docs` (doc_id, text).

    A window is `window` words in a row of an item of `benchmark` (item_id, text); an item of fewer words, but not none,
    is one window. Words of a document inside any occurrence of a window are hit. NULL and empty texts have no words.
    Every row of `docs` is told for itself, also where doc_id is NULL or repeated. Rows of `benchmark` that share an
    item_id count as one item; a NULL item_id is written as an empty string. Without items nothing is hit; an empty
    table gives no rows; other columns are ignored.
    """
    found = search_shards(index_shards(docs, window), benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans", "items")


def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the spans of words, blanks and signs within a span included."""
    out = []
    for text, cut in zip(texts, spans):
        if cut is not None and len(cut):
            data = text.encode()
            _, _, starts, ends = split_words([data])
            borders = [0, *(x for s in cut for x in (int(starts[s["start"]]), int(ends[s["end"] - 1]))), len(data)]
            text = b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2])).decode()
        out.append(text)
    return pd.Series(out, dtype=object)


def remove_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with their columns, without the passages that `contamination` finds. Texts that have none stay as they are."""
    key, cut = "__passage_of", "__passages"
    if {key, cut} & set(docs.columns):
        raise ValueError(f"columns {key} and {cut} are used inside")
    digest = F.sha2(whole(), 256)
    told = contamination(docs.select(digest.alias("doc_id"), "text"), benchmark, window).filter("contaminated")
    spans = told.groupBy(F.col("doc_id").alias(key)).agg(F.first("spans").alias(cut))
    joined = docs.join(spans, digest == F.col(key), "left")
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(F.pandas_udf(_without, "string")("text", cut))
    return joined.withColumn("text", text).select(*docs.columns)
