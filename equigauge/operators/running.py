"""Running totals, neighbours and lookups along an order, of series of any length.

Rows are cut into ranges of the order, first by their keys, so a long series spreads over as many ranges as it needs. Each
range is worked on by itself; what it takes over from the ranges before it or after it comes from a table with one row per
range and series, so a window never holds more than a range, or the ranges of one series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equigauge.session import settle

_PART = "_range"


def in_ranges(df: DataFrame, order: Sequence[str], pieces: int | None = None) -> DataFrame:
    """`df`, stored, with the number of its range in `order`; ranges have about equal numbers of rows.

    There are as many as the session has shuffle partitions, or `pieces`. Rows that are equal in all of `order` share a
    range, so a column that tells ties apart belongs at its end.
    """
    dealt = df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)
    return settle(dealt.withColumn(_PART, F.spark_partition_id()))


def scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, sums: Mapping[str, str] | None = None, previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None, latest: Mapping[str, str] | None = None, pieces: int | None = None,
) -> DataFrame:
    """Columns over the rows of the same `keys` in `order`: per name the running sum of a column up to the row, the value
    of the row before or after it, or the last known value up to it. Rows with a NULL key are left out.

    A frame that `in_ranges` has placed is not placed again, and the result stays placed, so scans can follow each other.
    """
    keys, order = list(keys), list(order)
    sums, previous, following, latest = (dict(x or {}) for x in (sums, previous, following, latest))
    known = df.na.drop(subset=keys) if keys else df
    placed = known if _PART in df.columns else in_ranges(known, [*keys, *order], pieces)
    place = F.struct(*order)
    ends = [
        *(F.sum(c).alias(f"_sum_{out}") for out, c in sums.items()),
        *(F.max_by(c, place).alias(f"_previous_{out}") for out, c in previous.items()),
        *(F.min_by(c, place).alias(f"_following_{out}") for out, c in following.items()),
        *(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"_latest_{out}") for out, c in latest.items()),
    ]
    of_ranges = Window.partitionBy(*keys).orderBy(_PART)
    earlier = of_ranges.rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy(*keys, _PART).agg(*ends).select(
        *keys, _PART,
        *(F.sum(f"_sum_{out}").over(earlier).alias(f"_sum_{out}") for out in sums),
        *(F.lag(f"_previous_{out}").over(of_ranges).alias(f"_previous_{out}") for out in previous),
        *(F.lead(f"_following_{out}").over(of_ranges).alias(f"_following_{out}") for out in following),
        *(F.last(f"_latest_{out}", ignorenulls=True).over(earlier).alias(f"_latest_{out}") for out in latest),
    )
    inside = Window.partitionBy(*keys, _PART).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first, last = F.lag(_PART).over(inside).isNull(), F.lead(_PART).over(inside).isNull()
    added = [
        *((F.sum(c).over(upto) + F.coalesce(f"_sum_{out}", F.lit(0))).alias(out) for out, c in sums.items()),
        *(F.when(first, F.col(f"_previous_{out}")).otherwise(F.lag(c).over(inside)).alias(out) for out, c in previous.items()),
        *(F.when(last, F.col(f"_following_{out}")).otherwise(F.lead(c).over(inside)).alias(out) for out, c in following.items()),
        *(F.coalesce(F.last(c, ignorenulls=True).over(upto), f"_latest_{out}").alias(out) for out, c in latest.items()),
    ]
    return placed.join(carried, [*keys, _PART]).select(*placed.columns, *added)


def unplaced(df: DataFrame) -> DataFrame:
    """Without the number of the range."""
    return df.drop(_PART)


def running_total(df: DataFrame, order: str, values: dict[str, str], pieces: int | None = None) -> DataFrame:
    """Add `out = sum(value)` over all rows up to the row in the order of a column with distinct values."""
    return unplaced(scan(df, [], [order], sums=values, pieces=pieces))


def last_at_most(probes: DataFrame, marks: DataFrame, at: str, payload: list[str], pieces: int | None = None) -> DataFrame:
    """For each distinct probe the payload of the last mark at or below it; NULL where there is none.

    Marks carry a position column `i` that rises with `at`.
    """
    carried = F.struct("i", *payload)
    rows = marks.select(at, F.lit(0).alias("_probe"), "i", carried.alias("_mark"))
    asked = probes.select(at, F.lit(1).alias("_probe"), F.lit(None).cast(rows.schema["i"].dataType).alias("i"),
                          F.lit(None).cast(rows.schema["_mark"].dataType).alias("_mark"))
    found = scan(rows.unionByName(asked), [], [at, "_probe", "i"], latest={"_hit": "_mark"}, pieces=pieces)
    return found.filter("_probe = 1").select(at, "_hit.*")
