"""Collocations by dynamic itemset counting.

The corpus is dealt over `SHARDS` shards, which are scanned in a cycle, one per step. Words are counted from the first
step. A longer phrase becomes active at the step after both its shorter parts, without its last and without its first
word, have reached the threshold, is counted in that shard and the following ones, and is complete after one full cycle;
so all lengths are counted interleaved and the scans end when nothing is active.

In these steps a phrase is a hash: tasks send each bucket of hashes four bytes and a count per phrase, so sums can only
be too large. Tasks learn what has reached the threshold from a table of cells, sent out before each step: a cell holds
the first step at which a phrase that falls there reached it, and never changes once it is set. Two cells tell about a
phrase, and the later one counts. A phrase may so be taken as active though it is not, or from an earlier step; as cells
are fixed, every task agrees on its first step, so it is still counted in every shard. A phrase that has reached the
threshold is left out of the steps and counted, by its words, in a last cycle over all shards, which gives the numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigauge.llm.batches import reduced
from equigauge.llm.caches import cache_of
from equigauge.llm.fm_index import binary_array
from equigauge.llm.text import whole
from equigauge.session import settle

SHARDS, LONGEST = 2, 4
#: Bytes of text counted at once, bytes whose words are hashed at once, and bytes of all text per bucket of hashes.
CHUNK, BLOCK, BUCKET_BYTES = 4 << 20, 1 << 18, 8 << 20
#: Cells of the table of steps: one per so many bytes of text, between these powers of two, so at most 16 MB.
BYTES_PER_CELL, LEAST_CELLS, MOST_CELLS = 16, 16, 24
#: In a cell: not reached yet.
NEVER = 255
UNKNOWN = "und"
#: What a byte is: 0 a part of a word, else a blank, or the end of a piece.
_ENDS = 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _ENDS
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_BYTE = np.random.Generator(np.random.PCG64(12)).integers(1, 2**63, 256, dtype=np.uint64)
_COUNTED = pa.schema([("lang", pa.string()), ("size", pa.int8()), ("phrase", pa.string()), ("n", pa.int64())])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of `base`, kept by the worker."""
    held = cache_of("collocations")
    if len(held.get(base, ())) < n:
        out = np.full(max(n, 2 * BLOCK), base, np.uint64)
        out[0] = 1
        held[base] = np.cumprod(out)
    return held[base][:n]


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Phrases:
    """The words of some texts in lower case, by lang and piece, and the hashes of the phrases they make."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.data = _FOLD[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        kind = _KIND[self.data]
        self.inside = kind == 0
        edge = np.flatnonzero(np.diff(self.inside, prepend=False, append=False))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.piece = np.cumsum(kind == _ENDS, dtype=np.int32)[self.starts]
        self.sizes = np.diff(np.searchsorted(self.starts, np.cumsum([0, *(len(t) + 1 for t in texts)])))
        self.langs = sorted(set(langs))
        number = {lang: k for k, lang in enumerate(self.langs)}
        self.lang = np.repeat(np.array([number[x] for x in langs], np.int64), self.sizes)

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, from running sums over blocks of bytes."""
        out, a = np.empty(len(self.starts), np.uint64), 0
        while a < len(out):
            first = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.ends, first + BLOCK, "right")))
            starts, ends = self.starts[a:b] - first, self.ends[a:b] - first
            n = int(ends[-1])
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.data[first:first + n]] * _powers(_STEP, n), out=sums[1:])
            out[a:b] = _mix((sums[ends] - sums[starts]) * _powers(_BACK, n)[starts] + (ends - starts).astype(np.uint64))
            a = b
        return out

    def numbered(self) -> None:
        """Give each distinct word a number, for exact counts."""
        coded = binary_array(self.ends - self.starts, self.data[self.inside]).dictionary_encode()
        self.words, self.ids = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)

    def counted(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the phrases of this size at these places: the place of one of each, and how many there are."""
        key, most = self.lang[at], len(self.langs)
        for k in range(size):
            if most * len(self.words) >= 2**63:
                key = np.unique(key, return_inverse=True)[1]
                most = int(key.max(initial=0)) + 1
            key = key * len(self.words) + self.ids[at + k]
            most *= len(self.words)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return at[order[first]], np.diff(np.append(first, len(key)))

    def texts(self, at: np.ndarray, size: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.ids[at + k])) for k in range(size)]
        return pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]


def cell_places(keys: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each reduced hash."""
    mixed, mask = _mix(keys), np.uint64(cells - 1)
    return (mixed & mask).astype(np.int64), ((mixed >> np.uint64(32)) & mask).astype(np.int64)


def cell_steps(keys: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """When each reduced hash reached the threshold."""
    one, other = cell_places(keys, len(cells))
    return np.maximum(cells[one], cells[other])


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    texts, langs = batch["bytes"].to_pylist(), batch["lang"].to_pylist()
    a = size = 0
    for b, text in enumerate(texts, 1):
        size += len(text)
        if size >= CHUNK or b == len(texts):
            yield texts[a:b], langs[a:b]
            a, size = b, 0


def reached_at(phrases: Phrases, cells: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By size: where phrases begin both of whose parts have reached the threshold, their reduced hashes, the steps at
    which they and at which both their parts reached it.
    """
    words = phrases.word_hashes()
    lang_hash = np.array([_lang_hash(x) for x in phrases.langs], np.uint64)
    at = np.arange(len(words))
    hashes = _mix(lang_hash[phrases.lang] + words)
    parts = np.zeros(len(at), np.uint8)
    for size in range(1, LONGEST + 1):
        if size > 1:
            # The step of each shorter phrase by its place, and its hash.
            shorter, before = np.full(len(words) + 1, NEVER, np.uint8), np.zeros(len(words), np.uint64)
            shorter[at], before[at] = own, hashes
            steps = np.maximum(shorter[at], shorter[at + 1])
            live = steps != NEVER
            at, parts = at[live], steps[live]
            one_piece = phrases.piece[at] == phrases.piece[at + size - 1]
            at, parts = at[one_piece], parts[one_piece]
            hashes = _mix(before[at] * np.uint64(_STEP) + words[at + size - 1])
        keys = reduced(hashes, buckets)
        # Cells that others have set may name a step before its parts were known, when it could not be seen yet.
        own = np.maximum(cell_steps(keys, cells), parts)
        yield size, at, keys, own, parts
        if not len(at):
            return


def _packed(keys: np.ndarray, buckets: int, kind: str) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, rests, counts) of reduced keys, which may be repeated."""
    n = np.uint64(buckets)
    mixed = np.sort(((keys % n) << np.uint64(32)) | (keys // n))
    first = np.flatnonzero(np.concatenate([[True], mixed[1:] != mixed[:-1]]))
    counts = np.minimum(np.diff(np.append(first, len(mixed))), np.iinfo(kind).max).astype(kind)
    mixed = mixed[first]
    rests = mixed.astype("<u4")
    bucket = (mixed >> np.uint64(32)).astype(np.int64)
    names, starts = np.unique(bucket, return_index=True)
    for name, a, b in zip(names.tolist(), starts, [*starts[1:], len(bucket)]):
        yield name, rests[a:b].tobytes(), counts[a:b].tobytes()


def _counted(step: int, shards: int, buckets: int, kind: str, sent):
    """Counts of the phrases that are active in this step, with the step at which each became so."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_of("collocations")
        cells = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for texts, langs in _chunks(batch):
                found: dict[int, list[np.ndarray]] = {}
                for size, at, keys, own, parts in reached_at(Phrases(texts, langs), cells, buckets):
                    start = parts.astype(np.int64) + (size > 1)
                    for k in range(max(0, step - shards + 1), step + 1):
                        found.setdefault(k, []).append(keys[(own == NEVER) & (start == k)])
                for start, several in found.items():
                    keys = np.concatenate(several)
                    if len(keys):
                        names, rests, counts = zip(*_packed(keys, buckets, kind))
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([start] * len(names), pa.int16()), pa.array(rests, pa.binary()), pa.array(counts, pa.binary())],
                                                         ["bucket", "start", "rests", "counts"])
    return run


def _merged(step: int, shards: int, buckets: int, kind: str, least: int):
    """Of one bucket: what has reached the threshold, and the counts of other phrases whose cycle goes on."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        bucket, out = int(part["bucket"].iloc[0]), []
        for start, mine in part.groupby("start"):
            rests = np.frombuffer(b"".join(mine["rests"]), "<u4")
            order = np.argsort(rests)
            rests = rests[order]
            first = np.flatnonzero(np.concatenate([[True], rests[1:] != rests[:-1]]))
            total = np.add.reduceat(np.frombuffer(b"".join(mine["counts"]), kind)[order].astype(np.int64), first)
            rests, many = rests[first], total >= least
            reached = rests[many].astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
            goes_on = ~many & (start > step - shards + 1)
            out.append((bucket, start, rests[goes_on].tobytes(), np.minimum(total, np.iinfo(kind).max).astype(kind)[goes_on].tobytes(), reached.tobytes()))
        return pd.DataFrame(out, columns=["bucket", "start", "rests", "counts", "reached"])
    return run


def _cells_of(cells: int):
    """The cells of reduced hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch["reached"].to_pylist()), "<u8")
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(cell_places(keys, cells))))], ["cell"])
    return run


def _mark(cells: np.ndarray, state: DataFrame, step: int) -> None:
    """Set the cells of what was reached in this step, unless they are set. What comes back is at most a bit per cell."""
    bits = state.select("reached").mapInArrow(_cells_of(len(cells)), "cell long").selectExpr("cell + 1 AS cell")
    for row in bits.groupBy(F.expr("bitmap_bucket_number(cell)").alias("bucket")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(cell))").alias("bits")).toLocalIterator():
        bit = np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little"))
        at = (row["bucket"] - 1) * 32_768 + bit
        cells[at[cells[at] == NEVER]] = step


def _exact(buckets: int, sent):
    """Counts of the phrases that have perhaps reached the threshold, by their words; as size 0, of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache_of("collocations")
        cells = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for texts, langs in _chunks(batch):
                phrases = Phrases(texts, langs)
                phrases.numbered()
                names = pa.array(phrases.langs, pa.string())
                total = np.bincount(phrases.lang, minlength=len(phrases.langs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([names, pa.array(np.zeros(len(total), np.int8)), pa.array([""] * len(total)), pa.array(total)], schema=_COUNTED)
                for size, at, _, own, _ in reached_at(phrases, cells, buckets):
                    first, n = phrases.counted(at[own != NEVER], size)
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(phrases.lang[first])), pa.array(np.full(len(first), size, np.int8)),
                                                      phrases.texts(first, size), pa.array(n.astype(np.int64))], schema=_COUNTED)
    return run


def frequent_phrases(docs: DataFrame, least: int = 30, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, n) of all phrases of up to `LONGEST` words that occur `least` times, and (lang, n) of all words."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), whole().cast("binary").alias("bytes"),
                       F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    cells = np.full(1 << min(MOST_CELLS, max(LEAST_CELLS, (total // BYTES_PER_CELL).bit_length())), NEVER, np.uint8)
    buckets, kind = total // BUCKET_BYTES + 1, "u1" if least < 256 else "<u4"
    counted, state, step, last_new = "bucket int, start smallint, rests binary, counts binary", None, 0, -1
    while True:
        sent = context.broadcast(cells.tobytes())
        found = rows.filter(F.col("shard") == step % shards).select("lang", "bytes").mapInArrow(_counted(step, shards, buckets, kind, sent), counted)
        if state is not None:
            found = found.union(state.drop("reached").filter(F.octet_length("rests") > 0))
        state = settle(found.groupBy("bucket").applyInPandas(_merged(step, shards, buckets, kind, least), f"{counted}, reached binary"))
        sent.destroy()
        if state.filter(F.octet_length("reached") > 0).limit(1).count():
            _mark(cells, state, step)
            last_new = step
        # What became active by the newest finds has had its cycle then, also in shards where it does not occur.
        if step >= last_new + shards:
            break
        step += 1
    counts = settle(rows.select("lang", "bytes").mapInArrow(_exact(buckets, context.broadcast(cells.tobytes())), "lang string, size tinyint, phrase string, n long").groupBy(
        "lang", "size", "phrase").agg(F.sum("n").alias("n")).filter((F.col("size") == 0) | (F.col("n") >= least)))
    return counts.filter("size > 0"), counts.filter("size = 0").select("lang", "n")


def _joined(first: str, size: str) -> Column:
    return F.expr(f"array_join(slice(words, {first}, {size}), ' ')")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, shards: int = SHARDS, scale: int = 2_000_000, covered: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score (numbers long): the best phrases of 2 to 4 words of each lang.

    `docs` has doc_id, text and lang. Texts are lowered in A-Z, split into pieces at `.,;:!?` and line ends, and those
    into words at blanks and tabs. Counts are per lang, NULL as `und`. Phrases that occur at least `least` times are
    candidates; the score is the least, over all cuts, of `scale` * a / (l + r), rounded down. Candidates inside a longer
    one that occurs at least `covered` of 100 times as often are dropped. NULL and empty texts have no phrases. Every row
    counts, repeated ones too; doc_id only deals rows over shards. Ties end with the phrase in order of its UTF-8 bytes.
    An empty table gives no rows; other columns are ignored.
    """
    known, words = frequent_phrases(docs, least, shards)
    candidates = known.filter("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = candidates.select(
        "lang", "phrase", "size", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("size").cast("int") - 1)).alias("cut"))
    sides = cuts.select("lang", "phrase", "a", "cut", _joined("1", "cut").alias("head"), _joined("cut + 1", "size - cut").alias("tail"))
    part = known.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    with_head = sides.join(part.toDF("lang", "head", "l"), ["lang", "head"])
    both = with_head.join(part.toDF("lang", "tail", "r"), ["lang", "tail"])
    score = F.expr(f"cast(a AS decimal(20, 0)) * {scale} div (cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0)))")
    lowest = both.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least"))
    inner = F.expr("""flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), k -> array_join(slice(words, k, m), ' '))))""")
    longer = candidates.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    free = F.col("most").isNull() | (wide("most") * 100 < wide("a") * covered)
    told = lowest.join(longer, ["lang", "phrase"], "left").filter(free).select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = told.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
