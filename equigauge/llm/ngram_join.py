"""Similarity join on word shingles by signature trees.

A document is the set of hashes of its word shingles. The range of hashes is cut into as many parts as two sets of their
size may differ in, and some more, so similar sets agree in all of at least one part: the hash of a set's share in a part
is a key, and only sets that have a key in common ever meet. Unlike a single shingle, a key of several is hardly shared
by chance. The sets of a key form a signature tree: leaves hold a bitmap of the set's hashes and its size, nodes the OR
of the bitmaps below and the range of sizes. Two nodes are compared by the largest overlap their bitmaps allow, and a
pair that cannot reach the wanted overlap is left with all that is below it. What remains ties documents into blocks. In
each block a second tree, over whole sets, is traversed in the same way, and its remaining pairs are compared word by
word; pairs that are connected already are passed over, so groups of many near copies cost little more than a chain.

Both steps go in two rounds. A few keys of each set connect nearly everything; of the other keys, only those are sent
out whose sets are not connected yet. A key or block of many sets is dealt over parts twice, at random, and what is then
not connected yet meets part by part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.llm.batches import BUCKET_KEYS, NO_ID, looked_up, received, reduced, repeated_keys
from equigauge.llm.caches import cache_of
from equigauge.llm.components import connected_components
from equigauge.llm.fm_index import binary_array
from equigauge.llm.joins import with_group
from equigauge.llm.text import whole
from equigauge.session import settle, settled

#: Bytes of text hashed at once, sets per batch, entries per bucket.
CHUNK = 1 << 20
BATCH_ROWS = 8_192
BUCKET_ROWS = 4_096
#: What one task compares under a key, or in a block: a set counts as one and one more per `COST_SIZE` of its shingles.
BUSY_ROWS = 4_096
BLOCK_ROWS = 4_096
COST_SIZE = 512
#: Parts of the range of hashes whose keys are sent out in the first round.
FEW = 3
FANOUT, PAIRS = 8, 4_096
#: Cells of the table in which pairs are compared exactly.
TABLE = 1 << 25
WORD_BITS = 64
#: Bits per member of the map that tells which documents may belong to a block, and its powers of two: at most 8 MB.
MEMBER_BITS, LEAST_BITS, MOST_BITS = 16, 15, 26
#: Words whose hash a worker keeps.
KNOWN_WORDS = 100_000
_HASH_KEY = b"equigauge words"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def coded_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts, the number of each word in turn, and how many words each text has.

    Words are runs of bytes other than blank and tab to carriage return, A-Z in lower case.
    """
    data = _FOLD[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    coded = binary_array(ends - starts, data[inside]).dictionary_encode()
    sizes = np.diff(np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)])))
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), sizes


def _word_hashes(words: pa.Array) -> np.ndarray:
    known = cache_of("ngram_join")
    out = np.empty(len(words), np.uint64)
    for k, word in enumerate(words.to_pylist()):
        h = known.get(word)
        if h is None:
            h = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=_HASH_KEY).digest(), "little")
            if len(known) < KNOWN_WORDS:
                known[word] = h
        out[k] = h
    return out


def _distinct(values: np.ndarray, owners: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct values of each of n owners."""
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    if len(values):
        new = np.concatenate([[True], (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])])
        values, owners = values[new], owners[new]
    return np.split(values, np.searchsorted(owners, np.arange(1, n)))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of `width` words of each text.

    A text with fewer words is one shingle, one without words is empty.
    """
    if not texts:
        return []
    dictionary, ids, sizes = coded_words(texts)
    words = _word_hashes(dictionary)[ids]
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = max(0, len(words) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width if n else 0):
        total = total * _STEP + words[k:n + k]
    fits = owner[:n] == owner[width - 1:] if n else np.zeros(0, bool)
    out = _distinct(_mix(total)[fits], owner[:n][fits], len(texts))
    first = np.cumsum(sizes) - sizes
    for k in np.flatnonzero((sizes > 0) & (sizes < width)):
        total = np.zeros(1, np.uint64)
        for w in words[first[k]:first[k] + sizes[k]]:
            total = total * _STEP + w
        out[k] = _mix(total + np.uint64(sizes[k]))
    return out


def exact_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The shingles of each text as numbers that are equal only for the same words."""
    if not texts:
        return []
    dictionary, ids, sizes = coded_words(texts)
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = max(0, len(ids) - width + 1)
    number, most = np.zeros(n, np.int64), 1
    for k in range(width if n else 0):
        if most * len(dictionary) >= 2**63:
            number = np.unique(number, return_inverse=True)[1]
            most = int(number.max()) + 1
        number = number * len(dictionary) + ids[k:n + k]
        most *= len(dictionary)
    fits = owner[:n] == owner[width - 1:] if n else np.zeros(0, bool)
    number = np.unique(number[fits], return_inverse=True)[1].astype(np.uint64)
    out = _distinct(number, owner[:n][fits], len(texts))
    first, short = np.cumsum(sizes) - sizes, {}
    for k in np.flatnonzero((sizes > 0) & (sizes < width)):
        words = ids[first[k]:first[k] + sizes[k]].tobytes()
        out[k] = np.array([2**63 + short.setdefault(words, len(short))], np.uint64)
    return out


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The set as bits of 64-bit words, about one bit or more per hash."""
    width = max(WORD_BITS, 1 << int(len(hashes) - 1).bit_length()) if len(hashes) else WORD_BITS
    bits = np.zeros(width, np.uint8)
    bits[(hashes % np.uint64(width)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


class Similarity:
    """At least `share` of the union in common, as an exact fraction."""

    def __init__(self, share: Fraction):
        self.share = share
        self.part = share / (1 + share)

    def prefix(self, n: int) -> int:
        return n - -(-self.share.numerator * n // self.share.denominator) + 1

    def least_overlap(self, sizes: np.ndarray) -> np.ndarray:
        """Overlap needed by sets whose sizes have these sums."""
        return -(-self.part.numerator * sizes // self.part.denominator)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether size a is not too small for size b."""
        return a * self.share.denominator >= b * self.share.numerator

    def hold(self, sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of places in `sets` are similar, exactly.

        The sets of the pairs become rows of bits over the hashes that more than one of them has; pairs whose sets would
        need more than `TABLE` bits are halved.
        """
        places, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        sizes = np.array([len(sets[k]) for k in places], np.int64)
        _, column, times = np.unique(np.concatenate([sets[k] for k in places]), return_inverse=True, return_counts=True)
        shared = times > 1
        width = int(shared.sum())
        if len(places) * width > TABLE and len(a) > 1:
            half = len(a) // 2
            return np.concatenate([self.hold(sets, a[:half], b[:half]), self.hold(sets, a[half:], b[half:])])
        number = np.cumsum(shared) - 1
        common = shared[column]
        table = np.zeros((len(places), -(-max(width, 1) // WORD_BITS) * WORD_BITS), np.uint8)
        table[np.repeat(np.arange(len(places)), sizes)[common], number[column[common]]] = 1
        bits = np.packbits(table, axis=1, bitorder="little").view("<u8")
        x, y = at[:len(a)], at[len(a):]
        both = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64)
        return both * self.share.denominator >= (sizes[x] + sizes[y] - both) * self.share.numerator


class SignatureTree:
    """Leaves in the given order of size; a level above holds the OR, size range and largest excess of `FANOUT` nodes.

    The excess of a set is how many of its hashes fell on bits taken already, so the overlap of two sets is at most the
    number of bits they share plus the smaller excess. Bitmaps are repeated up to the widest of the tree; the bits that two
    of them share then count as often as the wider of the two is repeated, which is divided out.
    """

    def __init__(self, sizes: np.ndarray, bits: list[np.ndarray]):
        self.order = np.argsort(sizes, kind="stable")
        self.wide = max(map(len, bits))
        leaf = np.stack([np.tile(bits[k], self.wide // len(bits[k])) for k in self.order])
        width = np.array([len(bits[k]) for k in self.order], np.int64)
        excess = np.array([sizes[k] - np.bitwise_count(bits[k]).sum() for k in self.order], np.int64)
        size = sizes[self.order].astype(np.int64)
        self.levels = [(leaf, size, size, excess, width)]
        while len(leaf) > 1:
            at = np.arange(0, len(leaf), FANOUT)
            below = self.levels[-1]
            leaf = np.bitwise_or.reduceat(below[0], at)
            self.levels.append((leaf, np.minimum.reduceat(below[1], at), *(np.maximum.reduceat(column, at) for column in below[2:])))

    def possible(self, level: int, x: np.ndarray, y: np.ndarray, like: Similarity) -> np.ndarray:
        bits, low, high, excess, width = self.levels[level]
        out = like.near(high[x], low[y]) & like.near(high[y], low[x])
        k = np.flatnonzero(out)
        shared = np.bitwise_count(bits[x[k]] & bits[y[k]]).sum(axis=1, dtype=np.int64)
        shared = -(-shared * np.maximum(width[x[k]], width[y[k]]) // self.wide)
        out[k] = shared + np.minimum(excess[x[k]], excess[y[k]]) >= like.least_overlap(low[x[k]] + low[y[k]])
        return out

    def link(self, like: Similarity, same: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
             known: np.ndarray | None = None) -> list[tuple[int, int]]:
        """A spanning forest, as pairs of places, of the possible pairs, or of those for which `same` holds too.

        Places that are equal in `known` are connected already.
        """
        n = len(self.order)
        label, forest = np.arange(n) if known is None else np.unique(known[self.order], return_inverse=True)[1], []
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, x, y = stack.pop()
            if len(x) > PAIRS:
                stack.append((level, x[PAIRS:], y[PAIRS:]))
                x, y = x[:PAIRS], y[:PAIRS]
            if level == 0:
                open_ = label[x] != label[y]
                x, y = x[open_], y[open_]
            fits = self.possible(level, x, y, like)
            x, y = x[fits], y[fits]
            if level == 0:
                if same is not None and len(x):
                    true = same(self.order[x], self.order[y])
                    x, y = x[true], y[true]
                for a, b in zip(x.tolist(), y.tolist()):
                    if label[a] != label[b]:
                        label[label == label[b]] = label[a]
                        forest.append((int(self.order[a]), int(self.order[b])))
            elif len(x):
                size = len(self.levels[level - 1][1])
                cx = np.repeat(x * FANOUT, FANOUT * FANOUT) + np.tile(np.repeat(np.arange(FANOUT), FANOUT), len(x))
                cy = np.repeat(y * FANOUT, FANOUT * FANOUT) + np.tile(np.tile(np.arange(FANOUT), FANOUT), len(y))
                good = (cx < size) & (cy < size) & ((cx < cy) | ((cx == cy) & (level > 1)))
                stack.append((level - 1, cx[good], cy[good]))
        return forest


def width_bands(sizes: np.ndarray, widths: np.ndarray, like: Similarity) -> Iterator[np.ndarray]:
    """Places of sets, band by band: those of one width of bitmap, with the narrower ones that are near enough in size.

    Every pair of near sizes is in a band, and no bitmap is repeated beyond the width of a set that it may be similar to.
    """
    for wide in np.unique(widths):
        own = widths == wide
        at = np.flatnonzero(own | ((widths < wide) & like.near(sizes, sizes[own].min())))
        if len(at) > 1:
            yield at


def links_of(sizes: np.ndarray, bits: list[np.ndarray], like: Similarity,
             same: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of places that connect what `SignatureTree.link` connects, from one tree per band of width."""
    out = []
    for at in width_bands(sizes, np.array([len(b) for b in bits], np.int64), like):
        tree = SignatureTree(sizes[at], [bits[k] for k in at])
        within = None if same is None else lambda a, b, at=at: same(at[a], at[b])
        out += [(int(at[a]), int(at[b])) for a, b in tree.link(like, within, None if known is None else known[at])]
    return out


class Keys:
    """The keys of sets: two similar sets of different hashes have one in common.

    Sizes fall into bands. A set belongs to its own band and to those of larger sets that it may be similar to; a pair
    meets in the band of the larger. There, the range of hashes is cut into more parts than the two may differ in hashes,
    so one part that is not empty is the same in both, unless both have too many empty parts: such sets get, besides, the
    keys of their least hashes, of which similar sets share one.
    """

    WIDER = Fraction(7, 5)
    #: One part more for every so many, for parts that are empty.
    SPARE = 16

    def __init__(self, like: Similarity):
        self.like = like
        self.highest = np.zeros(1, np.int64)
        self._grow(1)

    def _grow(self, size: int) -> None:
        highest = self.highest.tolist()
        while highest[-1] < size:
            highest.append(int(highest[-1] * self.WIDER) + 1)
        self.highest = np.array(highest, np.int64)
        share = self.like.share
        self.differ = np.array([2 * h * (share.denominator - share.numerator) // (share.denominator + share.numerator) for h in highest], np.int64)
        self.parts = self.differ + 1 + 1 + self.differ // self.SPARE

    def of(self, sets: list[np.ndarray]) -> tuple[list[bytes], list[bytes]]:
        """The keys of the first `FEW` parts of every set, and its other keys."""
        sizes = np.array([len(s) for s in sets], np.int64)
        farthest = sizes * self.like.share.denominator // self.like.share.numerator
        self._grow(int(farthest.max(initial=1)))
        band, last = np.searchsorted(self.highest, sizes), np.searchsorted(self.highest, farthest)
        hashes = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owners = np.repeat(np.arange(len(sets)), sizes)
        found = []
        for step in range(int((last - band).max(initial=-1)) + 1):
            at = np.minimum(band + step, last)
            # Sets that can only be similar to equal ones need no key.
            mine = ((band + step <= last) & (self.differ[at] > 0))[owners]
            found.append(self._in_band(hashes[mine], owners[mine], at, sizes))
        keys, of, part = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        return tuple(self._per_set(keys[few], of[few], len(sets)) for few in (part < FEW, part >= FEW))

    @staticmethod
    def _per_set(keys: np.ndarray, of: np.ndarray, n: int) -> list[bytes]:
        order = np.argsort(of, kind="stable")
        keys, cuts = keys[order], np.searchsorted(of[order], np.arange(n + 1))
        return [keys[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    def _in_band(self, hashes: np.ndarray, owners: np.ndarray, band: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not len(hashes):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        part = (((hashes >> np.uint64(32)) * self.parts[band[owners]].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (owners[1:] != owners[:-1])]))
        of, place = owners[starts], part[starts]
        where = band[of].astype(np.uint64) << np.uint64(40)
        keys = _mix(np.add.reduceat(_mix(hashes), starts) + _mix(where + place.astype(np.uint64)))
        full = np.bincount(of, minlength=len(sizes))
        few = np.flatnonzero((full > 0) & (full <= self.differ[band]))
        if not len(few):
            return keys, of, place
        least = [hashes[a:a + self.like.prefix(n)] for a, n in zip(np.searchsorted(owners, few).tolist(), sizes[few].tolist())]
        again = np.repeat(few, [len(x) for x in least])
        extra = _mix(np.concatenate(least) + _mix((band[again].astype(np.uint64) << np.uint64(40)) + np.uint64(2**39)))
        return np.concatenate([keys, extra]), np.concatenate([of, again]), np.concatenate([place, np.full(len(again), FEW)])


def _features(width: int, like: Similarity):
    """Size and digest of every set; keys and bitmap where a task sees the set for the first time, of a document with an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, seen = Keys(like), set()
        for batch in batches:
            at, all_ids = 0, batch["id"].to_pylist()
            for part in chunks(batch["bytes"].to_pylist()):
                ids = all_ids[at:at + len(part)]
                at += len(part)
                sets = shingle_sets(part, width)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                early, late, bits = ([None] * len(part) for _ in range(3))
                fresh = []
                for k, (i, s, digest) in enumerate(zip(ids, sets, digests)):
                    if i != NO_ID and len(s) and digest not in seen:
                        seen.add(digest)
                        fresh.append(k)
                for k, few, others in zip(fresh, *keys.of([sets[k] for k in fresh])):
                    early[k], late[k], bits[k] = few, others, bitmap(sets[k]).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x, pa.binary()) for x in (digests, early, late, bits))],
                    ["id", "n", "digest", "early", "late", "bits"])
    return run


def _first_of_set(batch: pd.DataFrame) -> pd.DataFrame:
    return batch.sort_values("id", kind="stable").drop_duplicates("digest", ignore_index=True)


def _keys_of(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    first = _first_of_set(batch)
    return np.unique(np.frombuffer(b"".join([*first["early"], *first["late"]]), "<u8"), return_counts=True)


def _meeting(key_buckets: int):
    """Of a batch: the distinct sets with a key that others have too, and only such keys."""
    def run(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(batch) or not len(answers):
            return pd.DataFrame(columns=["id", "n", "early", "late", "bits"])
        batch = _first_of_set(batch)
        known = received(answers)
        for column in ("early", "late"):
            keys = np.frombuffer(b"".join(batch[column]), "<u8")
            of = np.repeat(np.arange(len(batch)), batch[column].map(len).to_numpy() // 8)
            many = looked_up(reduced(keys, key_buckets), *known) > 1
            batch[column] = Keys._per_set(keys[many], of[many], len(batch))
        some = (batch["early"].map(len) + batch["late"].map(len)) > 0
        return batch.loc[some, ["id", "n", "early", "late", "bits"]]
    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id, label, cost) for every key."""
    for batch in batches:
        keys = batch["keys"].to_pylist()
        take = pa.array(np.repeat(np.arange(len(keys)), [len(k) // 8 for k in keys]))
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(keys), "<i8")), *(batch[c].take(take) for c in ("id", "label", "cost"))], ["key", "id", "label", "cost"])


def keyed(sets: DataFrame, keys: Column) -> DataFrame:
    """(key, id, label, cost) of `sets` (id, n, label) by keys in one binary column."""
    cost = (F.lit(1) + F.col("n") / COST_SIZE).cast("long").alias("cost")
    return sets.select(keys.alias("keys"), "id", "label", cost).mapInArrow(_exploded, "key long, id long, label long, cost long")


def dealt(rows: DataFrame, most: int) -> DataFrame:
    """(key, id) of `rows` (key, id, cost), with keys that cost more than `most` replaced by two dealings over parts."""
    busy = rows.groupBy("key").agg(F.sum("cost").alias("all")).filter(F.col("all") > most).select(
        F.col("key").alias("of"), F.ceil(F.col("all") / most).alias("parts"))
    told = rows.join(busy, F.col("key") == F.col("of"), "left")
    parts = [F.xxhash64("key", F.lit(k), F.pmod(F.xxhash64("id", F.lit(k)), F.col("parts"))) for k in (1, 2)]
    return told.select(F.explode(F.when(F.col("parts").isNull(), F.array("key")).otherwise(F.array(*parts))).alias("key"), "id")


def _possible_links(like: Similarity):
    """Of a bucket of keys: links, per key, that connect the pairs that their signatures allow."""
    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        edges: set[tuple[int, int]] = set()
        for _, group in bucket.groupby("key", sort=False):
            ids = group["id"].to_numpy(np.int64)
            bits = [np.frombuffer(x, "<u8") for x in group["bits"]]
            edges.update((int(ids[a]), int(ids[b])) for a, b in links_of(group["n"].to_numpy(np.int64), bits, like))
        return pd.DataFrame(sorted(edges), columns=["u", "v"], dtype=np.int64)
    return run


def possible_links(rows: DataFrame, sets: DataFrame, like: Similarity, buckets: int) -> DataFrame:
    """Links (u, v) between `sets` (id, n, bits) that share a key of `rows` (key, id). Keys of the same sets count once."""
    groups = rows.groupBy("key").agg(F.sort_array(F.collect_set("id")).alias("ids")).filter(F.size("ids") > 1).select("ids").distinct()
    named = groups.select(F.xxhash64("ids").alias("key"), F.explode("ids").alias("id"))
    entries = named.join(sets.select("id", "n", "bits"), "id").withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    return entries.groupBy("bucket").applyInPandas(_possible_links(like), "u long, v long")


def meets(rows: DataFrame, most: int) -> DataFrame:
    """(key, of1, part1, of2, part2, id, label): which of `rows` (key, id, label, cost) must still meet, in pairs of parts.

    Labels of one key that cost at least `most` have parts of their own there, which never meet each other; the other rows
    of the key are pooled. All other pairs of parts meet, so no task holds more than two parts, and keys of one label none.
    """
    counts = rows.groupBy("key", "label").agg(F.sum("cost").alias("many"))
    several = counts.groupBy("key").agg(
        F.count(F.lit(1)).alias("labels"), F.sum(F.when(F.col("many") < most, F.col("many"))).alias("pool")).filter("labels > 1")
    large = F.col("many") >= most
    told = settle(counts.join(several, "key").select(
        "key", "label", F.when(large, F.col("label")).otherwise(F.lit(NO_ID)).alias("of"),
        F.ceil(F.when(large, F.col("many")).otherwise(F.col("pool")) / most).cast("int").alias("parts")))
    cells = told.select("key", "of", "parts").distinct().select("key", "of", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    first, second = cells.toDF("key", "of1", "part1"), cells.toDF("key", "of2", "part2")
    ordered = F.struct("of1", "part1") <= F.struct("of2", "part2")
    pairs = first.join(second, "key").filter(ordered & ((F.col("of1") != F.col("of2")) | (F.col("of1") == NO_ID)))
    sides = F.array_distinct(F.array(F.struct(F.col("of1").alias("of"), F.col("part1").alias("part")), F.struct(F.col("of2").alias("of"), F.col("part2").alias("part"))))
    met = pairs.withColumn("side", F.explode(sides)).select("key", "of1", "part1", "of2", "part2", "side.of", "side.part")
    placed = rows.join(told, ["key", "label"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    return placed.join(met, ["key", "of", "part"]).select(*CELL, "id", "label")


CELL = ["key", "of1", "part1", "of2", "part2"]


def _links_between(like: Similarity):
    """Of two parts of a busy key: links of the possible pairs that are not connected yet."""
    def run(met: pd.DataFrame) -> pd.DataFrame:
        ids = met["id"].to_numpy(np.int64)
        bits = [np.frombuffer(x, "<u8") for x in met["bits"]]
        found = links_of(met["n"].to_numpy(np.int64), bits, like, known=met["label"].to_numpy(np.int64))
        return pd.DataFrame([(ids[a], ids[b]) for a, b in found], columns=["u", "v"], dtype=np.int64)
    return run


def links_left(rows: DataFrame, sets: DataFrame, like: Similarity, busy_rows: int, buckets: int) -> DataFrame:
    """Links (u, v) under keys of `rows` (key, id, label, cost) between sets of different labels."""
    open_ = rows.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.sum("cost").alias("all")).filter(
        "least < most").select(F.col("key").alias("of"), (F.col("all") > busy_rows).alias("busy"))
    light = settle(rows.join(open_, F.col("key") == F.col("of")).select("key", "id", "label", "cost", "busy"))
    small = possible_links(light.filter("NOT busy").select("key", "id"), sets, like, buckets)
    met = meets(light.filter("busy").drop("busy"), busy_rows).join(sets.select("id", "n", "bits"), "id")
    return small.union(met.groupBy(*CELL).applyInPandas(_links_between(like), "u long, v long"))


def _true_links(width: int, like: Similarity):
    """Of a block, or of two of its parts: a spanning forest of the pairs that are similar and have different labels."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        cache_of("ngram_join").clear()  # sets need the room
        sets = exact_sets(block["bytes"].tolist(), width)
        ids = block["id"].to_numpy(np.int64)
        sizes = np.array([len(s) for s in sets], np.int64)
        known = block["label"].to_numpy(np.int64) if "label" in block else None
        found = links_of(sizes, [bitmap(_mix(s)) for s in sets], like, lambda a, b: like.hold(sets, a, b), known)
        return pd.DataFrame([(ids[a], ids[b]) for a, b in found], columns=["u", "v"], dtype=np.int64)
    return run


def _perhaps_in(rows: DataFrame, members: DataFrame, bits: int) -> DataFrame:
    """`rows` (id, ...) without most that are not among `members` (id), so their texts need not be moved.

    The hashes of the members set bits in a map of `bits`, which is sent to all in words.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = members.select(bit("id").alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("set_bits"))
    marked = rows.withColumn("bit", bit("id")).withColumn("of_word", F.expr("bit div 64"))
    kept = marked.join(F.broadcast(words), F.col("of_word") == F.col("word")).filter(
        F.expr("shiftrightunsigned(set_bits, cast(bit % 64 AS int)) & 1 = 1"))
    return kept.select(*rows.columns)


def _with_labels(sets: DataFrame, components: DataFrame) -> DataFrame:
    """`sets` (id, ...) with the component of each as label."""
    return sets.join(components.toDF("of_node", "of_component"), F.col("id") == F.col("of_node"), "left").select(
        *(c for c in sets.columns if c != "label"), F.coalesce("of_component", "id").alias("label"))


def _verified(rows: DataFrame, sets: DataFrame, blocks: DataFrame, width: int, like: Similarity) -> DataFrame:
    """True links (u, v) among the members of `blocks` (node, component), whose sizes are in `sets` and texts in `rows`."""
    placed = _with_labels(sets.select("id", "n"), blocks)
    cost = (F.lit(1) + F.col("n") / COST_SIZE).cast("long").alias("cost")
    sizes = placed.groupBy("label").agg(F.count(F.lit(1)).alias("many"), F.sum(cost).alias("all")).filter("many > 1").select(F.col("label").alias("key"), "all")
    members = settle(placed.withColumn("cost", cost).join(sizes, F.col("label") == F.col("key")).select("key", "id", "cost", F.col("label"), "all"))
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (MEMBER_BITS * members.count()).bit_length()))
    texts = settle(_perhaps_in(rows.filter(F.col("id") != NO_ID), members, bits))
    first = dealt(members, BLOCK_ROWS).join(texts, "id").groupBy("key").applyInPandas(_true_links(width, like), "u long, v long")
    links = settle(first)
    large = members.filter(F.col("all") > BLOCK_ROWS).drop("all")
    if large.isEmpty():
        return links
    again = _with_labels(large, connected_components(links))
    left = meets(again, BLOCK_ROWS).join(texts, "id").groupBy(*CELL).applyInPandas(_true_links(width, like), "u long, v long")
    return links.union(left)


def jaccard_groups(docs: DataFrame, width: int = 3, share: Fraction = Fraction(9, 10)) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs` (doc_id, text).

    Two documents link if they have at least `share` of their shingles of `width` words in common; component_id is the
    least doc_id that links reach. NULL text counts as empty; documents without words link with nothing. Rows that share a
    doc_id are one node of the graph and keep counts of their own. A NULL doc_id has no component. An empty table gives no
    rows; other columns are ignored.
    """
    like = Similarity(share)
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), whole().cast("binary").alias("bytes"))
    # Keys and bitmaps of sets that meet no other are not needed again.
    with settled(rows.mapInArrow(_features(width, like), "id long, n long, digest binary, early binary, late binary, bits binary")) as features:
        n_rows, key_bytes = features.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("early") + F.octet_length("late")), F.lit(0))).first()
        facts = settle(features.select("id", "n", "digest", F.col("early").isNotNull().alias("carries")))
        key_buckets, buckets = key_bytes // 8 // BUCKET_KEYS + 1, n_rows // BUCKET_ROWS + 1
        batches = features.filter("early IS NOT NULL").select(
            F.pmod(F.xxhash64("digest"), F.lit(n_rows // BATCH_ROWS + 1)).cast("int").alias("batch"), "id", "n", "digest", "early", "late", "bits")
        # Both uses of the batches read one exchange.
        repeats = repeated_keys(batches, _keys_of, key_buckets)
        sets = settle(batches.groupBy("batch").cogroup(repeats.groupBy("batch")).applyInPandas(
            _meeting(key_buckets), "id long, n long, early binary, late binary, bits binary")).withColumn("label", F.col("id"))
    found = settle(possible_links(dealt(keyed(sets, F.col("early")), BUSY_ROWS), sets, like, buckets))
    light = settle(_with_labels(sets.select("id", "n", "early", "late", "label"), connected_components(found)))
    left = links_left(keyed(light, F.concat("early", "late")), sets, like, BUSY_ROWS, buckets)
    blocks = connected_components(found.union(left))
    components = connected_components(_verified(rows, sets, blocks, width, like))
    named_sets = facts.filter((F.col("n") > 0) & (F.col("id") != NO_ID))
    stands = named_sets.groupBy("digest").agg(
        F.min("id").alias("least"), F.min(F.when(F.col("carries"), F.col("id"))).alias("id"), F.count(F.lit(1)).alias("copies"))
    told = settle(_with_labels(stands, components))
    least = told.groupBy("label").agg(F.min("least").alias("group"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    named = settle(told.join(least.select(F.col("label").alias("of"), "group"), F.col("label") == F.col("of"), "left").select(
        "digest", "copies", F.coalesce("group", "least").alias("component")))
    alone = facts.filter((F.col("n") == 0) | (F.col("id") == NO_ID)).select("id", "n", F.col("id").alias("component"))
    out = with_group(named_sets.select("id", "n", "digest"), named, "digest", "copies", n_rows).select("id", "n", "component").union(alone)
    return out.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.nullif("component", F.lit(NO_ID)).alias("component_id"))
