"""Texts in batches of bounded size, and the keys that occur more than once over all batches.

A batch is a share of the documents by the hash of their id, small enough for one task to hold. Keys are 64-bit hashes.
To learn which keys repeat, each batch sends every distinct key once, as four bytes, to the bucket that the key names; a
bucket answers each batch with those of its keys that others hold too. A key of any number of documents costs one entry
per batch. Two keys that fall together in a bucket only cause needless work later, as later steps compare contents.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.text import whole

#: Bytes of text in a batch, and keys in a bucket, on average.
BATCH_BYTES = 8 << 20
BUCKET_KEYS = 500_000
#: Stands for a NULL id inside the operators; it comes before all others.
NO_ID = -(2**63)

Keys = Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]


def text_batches(docs: DataFrame, id_column: str = "doc_id", batch_bytes: int = BATCH_BYTES) -> tuple[DataFrame, int]:
    """(batch, id, bytes) of every row, and the bytes of all. NULL text is empty, NULL ids become `NO_ID`."""
    rows = docs.select(F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("id"), whole().cast("binary").alias("bytes"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    return rows.select(F.pmod(F.xxhash64("id"), F.lit(total // batch_bytes + 1)).cast("int").alias("batch"), "id", "bytes"), total


def in_order(batch: pd.DataFrame) -> pd.DataFrame:
    """A batch by id; rows that share an id by their text. The same rows always come in the same order."""
    keys = ["id", "bytes"] if batch["id"].duplicated().any() else ["id"]
    return batch.sort_values(keys, kind="stable", ignore_index=True)


def reduced(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Keys as bucket and 32 further bits in one number."""
    n = np.uint64(buckets)
    return ((keys // n) & np.uint64(0xFFFFFFFF)) * n + keys % n


def repeated_keys(batches: DataFrame, keys_of: Keys, buckets: int, count_type: str = "u1") -> DataFrame:
    """(batch, keys, totals): the reduced keys of each batch that occur more than once, and how often in all.

    `keys_of` gives the distinct keys of a batch and how often each occurs there, which counts as at most the largest
    number of `count_type`. A batch may get several rows.
    """
    n, most = np.uint64(buckets), np.iinfo(count_type).max

    def send(batch: pd.DataFrame) -> pd.DataFrame:
        keys, counts = keys_of(batch)
        bucket = (keys % n).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rest = ((keys // n) & np.uint64(0xFFFFFFFF)).astype("<u4")[order]
        counts = np.minimum(counts, most).astype(count_type)[order]
        names, starts = np.unique(bucket[order], return_index=True)
        ends = [*starts[1:], len(order)]
        return pd.DataFrame({
            "bucket": names.astype(np.int32), "batch": np.full(len(names), batch["batch"].iloc[0], np.int32),
            "rest": [rest[a:b].tobytes() for a, b in zip(starts, ends)], "counts": [counts[a:b].tobytes() for a, b in zip(starts, ends)]})

    def answer(bucket: pd.DataFrame) -> pd.DataFrame:
        rests = [np.frombuffer(x, "<u4") for x in bucket["rest"]]
        distinct, at = np.unique(np.concatenate(rests), return_inverse=True)
        counts = np.frombuffer(b"".join(bucket["counts"]), count_type)
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)[at]
        out, start = [], 0
        for batch, rest in zip(bucket["batch"], rests):
            mine = total[start:start + len(rest)]
            start += len(rest)
            many = mine > 1
            if many.any():
                keys = rest[many].astype(np.uint64) * n + np.uint64(bucket["bucket"].iloc[0])
                out.append((batch, keys.tobytes(), np.minimum(mine[many], 2**31 - 1).astype("<u4").tobytes()))
        return pd.DataFrame(out, columns=["batch", "keys", "totals"])

    sent = batches.groupBy("batch").applyInPandas(send, "bucket int, batch int, rest binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(answer, "batch int, keys binary, totals binary")


def received(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The sorted repeated keys of a batch and their totals."""
    keys = np.frombuffer(b"".join(answers["keys"]), "<u8")
    totals = np.frombuffer(b"".join(answers["totals"]), "<u4")
    order = np.argsort(keys)
    return keys[order], totals[order]


def looked_up(keys: np.ndarray, known: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Total of each reduced key, 0 where it is not among the sorted `known`."""
    if not len(known):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, totals[at], 0).astype(np.int64)
