"""An FM-index over sequences of words: suffix order, wavelet matrix, backward search and sampled positions.

Words are numbered per index. Every sequence ends with a separator of its own, which no search can hold, so nothing is
found across two sequences. The index keeps the last-to-first text as a wavelet matrix, the counts of the words, and the
place in the text of every `STEP`th suffix and of every beginning of a sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text positions between two that are kept.
STEP = 8
WORD_BITS = 64
#: Words of which a first sort takes in, and the bits of a sort key.
FIRST, KEY_BITS = 3, 63


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places of `symbols` in the order of their suffixes. The last symbol must occur once.

    Ranks by the first words are refined by the ranks of the suffixes that follow; only ties are sorted again.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    depth = min(FIRST, KEY_BITS // bits)
    ahead = np.concatenate([symbols, np.zeros(depth, np.int64)])
    key = symbols.copy()
    for k in range(1, depth):
        key = (key << bits) | ahead[k:n + k]
    order = np.argsort(key)
    tied, group = _groups(key[order])
    rank = np.empty(n, np.int64)
    rank[order] = group
    places = np.flatnonzero(tied)
    while len(places):
        suffix = order[places]
        follows = suffix + depth
        key = (rank[suffix] << 31) | np.where(follows < n, rank[np.minimum(follows, n - 1)] + 1, 0)
        by = np.argsort(key)
        suffix = suffix[by]
        order[places] = suffix
        tied, group = _groups(key[by])
        rank[suffix] = places[group]
        places = places[tied]
        depth *= 2
    return order


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: whether each occurs more than once, and where its first is."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    return np.repeat(sizes > 1, sizes), np.repeat(starts, sizes)


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(np.pad(bits, (0, -len(bits) % WORD_BITS)), bitorder="little").view("<u8")


class Bits:
    """A row of bits that tells how many of the first i are set."""

    def __init__(self, words: np.ndarray):
        self.words = np.append(words, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        rest = self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(rest)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class FMIndex:
    """Finds sequences of words in a text of separated sequences. Symbol 0 is the separator, word k is symbol k + 1."""

    def __init__(self, dictionary: pa.Array, counts: np.ndarray, planes: np.ndarray, marks: np.ndarray, sampled: np.ndarray):
        self.dictionary, self.counts, self.sampled = dictionary, counts, sampled
        self.raw = planes, marks
        self.planes = [Bits(p) for p in planes]
        self.marks = Bits(marks)
        n, levels = int(counts.sum()), len(planes)
        self.zeros = [n - int(p.before[-1]) for p in self.planes]
        self.first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        # Symbols lie at the bottom of the matrix in the order of their reversed bits.
        symbol = np.arange(len(counts))
        flipped = np.zeros(len(counts), np.int64)
        for k in range(levels):
            flipped |= ((symbol >> k) & 1) << (levels - 1 - k)
        order = np.argsort(flipped)
        self.bottom = np.empty(len(counts), np.int64)
        self.bottom[order] = np.cumsum(counts[order], dtype=np.int64) - counts[order]

    @classmethod
    def build(cls, words: pa.Array, sizes: np.ndarray) -> FMIndex:
        """Of sequences that follow each other in `words`, of these sizes."""
        coded = words.dictionary_encode()
        ids = coded.indices.to_numpy().astype(np.int64)
        ends = np.cumsum(sizes + 1) - 1
        n = len(ids) + len(sizes)
        inside = np.ones(n, bool)
        inside[ends] = False
        # For the order, the separators are distinct and come before all words.
        symbols = np.empty(n, np.int64)
        symbols[ends] = np.arange(len(sizes))
        symbols[inside] = ids + len(sizes)
        order = suffix_order(symbols)
        text = np.zeros(n, np.uint32)
        text[inside] = ids + 1
        last = text[order - 1]
        planes = []
        for level in range(max(1, len(coded.dictionary).bit_length()) - 1, -1, -1):
            bit = ((last >> np.uint32(level)) & np.uint32(1)).astype(bool)
            planes.append(_packed(bit))
            last = np.concatenate([last[~bit], last[bit]])
        kept = order % STEP == 0
        begins = np.zeros(n, bool)
        begins[ends - sizes] = True
        kept |= begins[order]
        return cls(coded.dictionary, np.bincount(text, minlength=len(coded.dictionary) + 1), np.stack(planes), _packed(kept), order[kept].astype(np.uint32))

    def _down(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first i of the last-to-first text."""
        top = len(self.planes) - 1
        i = i.copy()
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            ones = plane.rank(i)
            i = np.where((symbols >> (top - k)) & 1, zeros + ones, i - ones)
        return i - self.bottom[symbols]

    def _back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that are one word longer."""
        i, symbols = rows, np.zeros(len(rows), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.get(i), plane.rank(i)
            symbols = (symbols << 1) | bit
            i = np.where(bit, zeros + ones, i - ones)
        return self.first[symbols] + i - self.bottom[symbols]

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Symbols of words, -1 for words that do not occur."""
        found = pc.index_in(words, value_set=self.dictionary)
        return pc.fill_null(found, -2).to_numpy().astype(np.int64) + 1

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of phrases as rows of symbols: those that occur, and the first and last row (exclusive) of each."""
        which = np.flatnonzero((phrases > 0).all(axis=1))
        symbols = phrases[which, -1]
        low, high = self.first[symbols], self.first[symbols + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            symbols = phrases[which, k]
            both = self._down(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
            low, high = self.first[symbols] + both[:len(which)], self.first[symbols] + both[len(which):]
            found = high > low
            which, low, high = which[found], low[found], high[found]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places in the text at which the suffixes of these rows begin."""
        out, steps = np.empty(len(rows), np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            known = self.marks.get(rows)
            out[open_[known]] = self.sampled[self.marks.rank(rows[known])].astype(np.int64) + steps
            open_, rows = open_[~known], self._back(rows[~known])
            steps += 1
        return out

    def stored(self) -> dict[str, object]:
        """What `loaded` takes."""
        planes, marks = self.raw
        lengths = pc.binary_length(self.dictionary).to_numpy().astype("<i4")
        return {
            "lengths": lengths.tobytes(), "letters": b"".join(self.dictionary.to_pylist()), "counts": self.counts.astype("<i4").tobytes(),
            "levels": len(planes), "planes": planes.tobytes(), "marks": marks.tobytes(), "sampled": self.sampled.astype("<u4").tobytes()}

    @classmethod
    def loaded(cls, row: dict) -> FMIndex:
        return cls(binary_array(np.frombuffer(row["lengths"], "<i4"), row["letters"]), np.frombuffer(row["counts"], "<i4").astype(np.int64),
                   np.frombuffer(row["planes"], "<u8").reshape(row["levels"], -1), np.frombuffer(row["marks"], "<u8"), np.frombuffer(row["sampled"], "<u4"))


def binary_array(lengths: np.ndarray, letters) -> pa.Array:
    """Binary values of these lengths, one after another in `letters`."""
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
