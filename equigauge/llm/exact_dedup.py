"""Exact duplicates against a history, by a minimal perfect hash over the digests of the history.

The history's distinct digests are dealt over shards. Each shard holds a minimal perfect hash of its digests: a few
levels of bit arrays, where a digest that is alone at its place of a level owns that bit and the others go on to the next
level; the rank of the owned bit is its slot. A slot holds the full digest and the locator of its winner. An incoming
digest is looked up at its one possible slot and counts as a member only if all bytes of the digest there agree; digests
without a slot of their own form groups of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.joins import with_group
from equigauge.llm.text import whole
from equigauge.session import settle

#: Digests of one shard; bounds what a task holds.
SHARD_DIGESTS = 32_768
#: Bits per digest still unplaced, at each level. More bits mean fewer levels.
SPREAD = 2
DIGEST_BYTES = 32
INDEX = "shard int, levels binary, widths array<long>, digests binary, winners array<long>, sizes array<long>"
_SLOTS = ["digest", "winner", "size"]


def _words(digests: np.ndarray) -> np.ndarray:
    """Digests as four 64-bit words each."""
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, DIGEST_BYTES // 8)


def _place(words: np.ndarray, level: int, width: int) -> np.ndarray:
    odd = np.uint64(2 * level + 1)
    mixed = (words[:, 0] + words[:, 1] * odd) ^ (words[:, 2] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(width)).astype(np.int64)


class PerfectHash:
    """Maps each of n known digests to a slot of its own in 0..n-1, and any other digest to some slot or to -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.cumsum(self.bits) - 1
        self.starts = np.cumsum([0, *map(len, levels)])

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        words, levels = _words(digests), []
        while len(words):
            width = SPREAD * len(words)
            at = _place(words, len(levels), width)
            alone = np.bincount(at, minlength=width) == 1
            levels.append(alone)
            words = words[~alone[at]]
        return cls(levels)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        words = _words(digests)
        out, still = np.full(len(words), -1, np.int64), np.arange(len(words))
        for level, owned in enumerate(self.levels):
            at = _place(words[still], level, len(owned))
            hit = owned[at]
            out[still[hit]] = self.rank[self.starts[level] + at[hit]]
            still = still[~hit]
        return out


def _bytes(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, DIGEST_BYTES)


def _build(part: pd.DataFrame) -> pd.DataFrame:
    digests = _bytes(part["digest"])
    table = PerfectHash.build(digests)
    order = np.argsort(table.slots(digests))
    return pd.DataFrame({
        "shard": [part["shard"].iloc[0]], "levels": [np.packbits(table.bits).tobytes()],
        "widths": [[len(x) for x in table.levels]], "digests": [digests[order].tobytes()],
        "winners": [part["winner"].to_numpy()[order]], "sizes": [part["size"].to_numpy()[order]],
    })


def _look_up(incoming: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """The groups of one shard: every slot of the history, raised by the members that came in, and the nonmembers."""
    asked = _bytes(incoming["digest"])
    if not len(index):
        return incoming.assign(member=False)[[*_SLOTS, "member"]]
    row = index.iloc[0]
    bits = np.unpackbits(np.frombuffer(row["levels"], np.uint8)).astype(bool)
    table = PerfectHash([x for x in np.split(bits[:sum(row["widths"])], np.cumsum(row["widths"])[:-1])])
    held = np.frombuffer(row["digests"], np.uint8).reshape(-1, DIGEST_BYTES)
    winners, sizes = np.array(row["winners"], np.int64), np.array(row["sizes"], np.int64)
    slots = table.slots(asked)
    member = slots >= 0
    member[member] = (held[slots[member]] == asked[member]).all(axis=1)
    at = slots[member]
    winners[at] = np.maximum(winners[at], incoming["winner"].to_numpy()[member])
    sizes[at] += incoming["size"].to_numpy()[member]
    old = pd.DataFrame({"digest": [x.tobytes() for x in held], "winner": winners, "size": sizes, "member": True})
    return pd.concat([old, incoming[~member].assign(member=False)[[*_SLOTS, "member"]]])


def history_index(groups: DataFrame) -> DataFrame:
    """One row per shard, as `INDEX` says, of `groups` (shard, digest, winner, size), one row per distinct digest."""
    return groups.groupBy("shard").applyInPandas(_build, INDEX)


def duplicate_groups(rows: DataFrame, shards: int) -> DataFrame:
    """The groups (digest, winner, size, member) of `rows` (digest, id, old): old rows are the history.

    Copies combine before the shuffle, so a digest of any number of rows costs one row per task.
    """
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    groups = rows.groupBy("digest", "old").agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("size")).withColumn("shard", shard)
    index = history_index(groups.filter("old").select("shard", *_SLOTS))
    incoming = groups.filter("NOT old").select("shard", *_SLOTS)
    return incoming.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(
        _look_up, "digest binary, winner long, size long, member boolean")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs` (doc_id, text).

    Texts are compared as they are; NULL counts as empty. The row with the largest doc_id of a group stays. The history
    is the lower half of the range of ids, the rest is looked up in it. NULL ids lose to all others; in a group of only
    NULL ids keep_id is NULL and no row is kept twice: none is marked. Repeated rows with one doc_id are all marked
    kept. An empty table gives no rows. Other columns are ignored.
    """
    rows = settle(docs.select("doc_id", F.unhex(F.sha2(whole(), 256)).alias("digest")))
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    middle = 0 if low is None else low + (high - low) // 2
    least = -(2**63)
    marked = rows.select("digest", F.coalesce("doc_id", F.lit(least)).alias("id"),
                         F.coalesce(F.col("doc_id") <= middle, F.lit(True)).alias("old"))
    groups = settle(duplicate_groups(marked, n // SHARD_DIGESTS + 1).select(
        "digest", F.nullif("winner", F.lit(least)).alias("keep_id"), F.col("size").alias("group_size")))
    return with_group(rows, groups, "digest", "group_size", n).select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
