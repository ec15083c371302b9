"""Repeatable samples and splits from hashed row keys.

The hash is uniform, so its leading digits cut the rows into slots of equal size. Counts per slot locate the slot in
which a split falls, and only that slot has to be sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equigauge.session import attach, settle

#: Hash digits that name a slot at least, and the rows of a slot that one task ranks, on average at most.
DIGITS = 3
SLOT_ROWS = 1_000_000
#: Digits of the whole hash; a slot of that length holds one key.
HASH_DIGITS = 32

# Sample sizes by scale; None is the whole table.
SCALES = {"POC": 2_000, "MEDIUM": 10_000, "FULL": None}


def key_hash(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def fixed_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the least key hash: each task keeps its own best n, nothing is sorted as a whole."""
    return df.orderBy(key_hash(key), key).limit(n)


def at_scale(df: DataFrame, key: str, scale: str) -> DataFrame:
    n = SCALES[scale]
    return df if n is None else fixed_sample(df, key, n)


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def hash_split(df: DataFrame, key: str, train: float = 0.8) -> DataFrame:
    """`part` by hash alone: about the wanted share, without any shuffle."""
    limit = int(round(train * 65536))
    slot = F.conv(F.substring(key_hash(key), 1, 4), 16, 10).cast("int")
    return df.withColumn("part", F.when(slot < limit, "train").otherwise("test"))


def exact_split(df: DataFrame, key: str, train: float = 0.8, strata: Sequence[str] = ()) -> DataFrame:
    """`part` so that exactly ceil(train * n) rows of the table, or of each stratum, are for training.

    Rows follow the order of their key hash. Rows of one key stay together, so a repeated key at the border may raise the
    share by its repeats. Rows with an unknown key or stratum have no part and do not count.
    """
    share = Fraction(train).limit_denominator(10_000)
    by = [f"_s{i}" for i in range(len(strata))]
    hashed = df.withColumns({"_h": key_hash(key), **{name: F.col(c) for name, c in zip(by, strata)}})
    cut = _cut_slots(hashed.na.drop(subset=["_h", *by]), by, share)

    # The last training key of each stratum; the table itself is then only compared with it. Keys are counted first, so
    # the repeats of a key cost one row per task.
    rows = _with_cut(hashed.na.drop(subset=["_h"]).select(*by, "_h", F.col(key).alias("_k")), by, cut)
    keys = rows.filter(F.col("_h").startswith(F.col("_cut"))).groupBy(*by, "_cut", "_take", "_h", "_k").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*by, "_cut").orderBy("_h", "_k").rowsBetween(Window.unboundedPreceding, -1)
    at_cut = keys.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    last = at_cut.groupBy(*by, "_cut").agg(F.max(F.when(F.col("_before") < F.col("_take"), F.struct("_h", "_k"))).alias("_l"))
    # With none to take from the slot, training ends before it; a prefix sorts before all its extensions.
    ends = last.select(*by, F.coalesce("_l._h", "_cut").alias("_end_h"), F.col("_l._k").alias("_end_k"))
    if by:
        placed = attach(hashed, ends, by, "left")
    else:
        one = ends.first()
        placed = hashed.withColumns({
            "_end_h": F.lit(one["_end_h"] if one else None).cast("string"),
            "_end_k": F.lit(one["_end_k"] if one else None).cast(df.schema[key].dataType),
        })
    upto = (F.col("_h") < F.col("_end_h")) | ((F.col("_h") == F.col("_end_h")) & (F.col(key) <= F.col("_end_k")))
    # Where no slot holds the split, every row is for training.
    part = F.when(F.col("_end_h").isNull() | F.coalesce(upto, F.lit(False)), "train").otherwise("test")
    for c in ["_h", *by]:
        part = F.when(F.col(c).isNotNull(), part)
    return placed.select(*df.columns, part.alias("part"))


def _cut_slots(hashed: DataFrame, by: list[str], share: Fraction) -> DataFrame:
    """Per stratum the slot in which the split falls, and how many of its rows belong to training.

    The number of digits that name a slot follows from the number of rows, so that a slot holds at most about `SLOT_ROWS`.
    """
    slots, digits = hashed.count() // SLOT_ROWS + 1, DIGITS
    while 16**digits < slots and digits < HASH_DIGITS:
        digits += 1
    sizes = hashed.groupBy(*by, F.substring("_h", 1, digits).alias("_cut")).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*by))
    wanted = F.floor((total * share.numerator + (share.denominator - 1)) / share.denominator)
    earlier = Window.partitionBy(*by).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumns({"_want": wanted, "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0))})
    held = (F.col("_before") <= F.col("_want")) & (F.col("_want") < F.col("_before") + F.col("_n"))
    return settle(placed.filter(held).select(*by, "_cut", (F.col("_want") - F.col("_before")).alias("_take")))


def _with_cut(rows: DataFrame, by: list[str], cut: DataFrame) -> DataFrame:
    if by:
        return attach(rows, cut, by, "left")
    one = cut.first()
    return rows.withColumns({
        "_cut": F.lit(one["_cut"] if one else None).cast("string"), "_take": F.lit(one["_take"] if one else None).cast("bigint")
    })
