"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Every source has a weight and a size in words. All targets together are `share` times all words. A target is the
source's weight times one common level, but at most `cap` times its size; the level is the one at which the targets
reach the wanted sum, which is where clamping the full sources and sharing their excess by weight comes to rest.

A source is then taken whole `floor(target / size)` times, and the rest from its documents in a seeded order until the
rest is used up; the document at the border gives only the words still missing. So every source's taken words are its
target to within rounding, and reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equigauge.llm.text import whole, word_count
from equigauge.session import settle

#: Hexadecimal digits of the seeded hash that name a slot at least, and the rows of a slot on average at most.
SLOT_DIGITS, SLOT_ROWS = 3, 100_000


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """`sizes` (source, source_size; one row per source) with `target`.

    Weights go round the sources in code point order, NULL last. The windows without partition run over one row per
    source, never over documents.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    limited = weighted.withColumn("most", F.lit(float(cap)) * F.col("source_size")).withColumn(
        "full_at", F.col("most") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    clamped = F.coalesce(F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    levels = limited.withColumn("wanted", F.lit(float(share)) * F.sum("source_size").over(everything)).withColumn(
        "level", (F.col("wanted") - clamped) / open_weight)
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything)
    target = F.least(F.col("most"), F.coalesce(level * F.col("weight"), F.col("most")))
    return levels.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        seed: int = 17) -> DataFrame:
    """One row per row of `docs` (doc_id, text, source): doc_id, source, size, source_size, target, taken, repeats.

    `taken` counts the words the mix takes of the document, `repeats` how often it appears in it, begun ones included.
    NULL text has size 0 and takes nothing; NULL is a source of its own, the last; a NULL doc_id is hashed as an empty
    one. A source without words has target 0. Rows that are alike in all of this share their places in any order.
    An empty table gives no rows; other columns are ignored. A source of any size is spread over the slots of its hash,
    whose number grows with the table, so no task sees more than a slot of it.
    """
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = settle(docs.select("doc_id", "source", word_count(whole()).alias("size")))
    digits = max(SLOT_DIGITS, math.ceil(math.log(max(1, sizes.count() / SLOT_ROWS), 16)))
    sized = sizes.withColumn("mark", mark).withColumn("slot", F.substring("mark", 1, digits))
    slots = sized.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    targets = source_targets(slots.groupBy("source").agg(F.sum("slot_size").alias("source_size")), weights, share, cap)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    shares = targets.withColumn("times", times).withColumn(
        "part", F.round("target").cast("long") - F.col("times") * F.col("source_size"))
    below = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    plan = slots.withColumn("slot_from", F.coalesce(F.sum("slot_size").over(below), F.lit(0))).alias("a").join(
        shares.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        F.col("a.source").alias("of"), F.col("slot").alias("at"), "slot_from", "source_size", "target", "times", "part")
    inside = Window.partitionBy("source", "slot").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    start = F.col("slot_from") + F.col("inside")
    taken = F.col("times") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - start))
    return placed.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("slot") == F.col("at"))).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
        (F.col("times") + (start < F.col("part")).cast("long")).alias("repeats"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix with all columns of `docs`, each as often as it is repeated.

    A repetition that is only begun counts as a whole one here, at most one document per source. Rows that share a
    doc_id are told apart by their source and text. NULL doc_ids are matched like any other; documents without words are
    never taken. Columns of any name and type come through.
    """
    key = F.sha2(F.to_json(F.struct("doc_id", "text", "source")), 256)
    keyed = docs.select(key.alias("key"), F.struct(*docs.columns).alias("row"))
    named = docs.select(key.alias("doc_id"), "text", "source")
    repeats = mix(named, **how).filter("repeats > 0").groupBy(F.col("doc_id").alias("of")).agg(F.max("repeats").alias("repeats"))
    turns = F.explode(F.sequence(F.lit(1).cast("long"), "repeats")).alias("turn")
    return keyed.join(repeats, F.col("key") == F.col("of")).select("row", turns).select("row.*")
