"""Row weights that even out groups and classes before training."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equigauge.functions.ratios import ratio
from equigauge.session import attach


def cell_weights(df: DataFrame, group: str, label: str) -> DataFrame:
    """Weight P(group) P(label) / P(group, label) per cell, from one count of the table.

    The sums run over the counted cells, of which there are as many as groups times labels.
    """
    cells = df.filter(F.col(group).isNotNull() & F.col(label).isNotNull()).groupBy(group, label).agg(
        F.count(F.lit(1)).alias("n_cell")
    )
    by_group = cells.groupBy(group).agg(F.sum("n_cell").alias("n_group"))
    by_label = cells.groupBy(label).agg(F.sum("n_cell").alias("n_label"))
    total = cells.agg(F.sum("n_cell")).scalar()
    return cells.join(by_group, group).join(by_label, label).select(
        group, label, "n_cell", "n_group", "n_label",
        ratio(F.col("n_group") * F.col("n_label"), total * F.col("n_cell"), 1.0).alias("weight"),
    )


def reweighed(df: DataFrame, group: str, label: str, out: str = "weight") -> DataFrame:
    """The table with its weights; rows with an unknown group or label weigh 1."""
    weights = cell_weights(df, group, label).select(group, label, F.col("weight").alias(out))
    return attach(df, weights, [group, label], "left").withColumn(out, F.coalesce(out, F.lit(1.0)))


def weighted_rates(df: DataFrame, group: str, label: str, weight: str, positive: object = 1) -> DataFrame:
    """Weighted share of positives per group."""
    y = (F.col(label) == F.lit(positive)).cast("int")
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        ratio(F.sum(F.col(weight) * y), F.sum(weight)).alias("weighted_rate")
    )


def gaussian_kernel(sigma: float = 1.0, truncate: float = 4.0) -> list[float]:
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [x / sum(raw) for x in raw]


def smoothing_matrix(n: int, sigma: float = 1.0) -> list[list[float]]:
    """Share of class j in the smoothed count of class i; positions beyond an end are mirrored, the end repeated."""
    kernel = gaussian_kernel(sigma)
    radius = len(kernel) // 2
    out = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for k, w in enumerate(kernel):
            j = (i + k - radius) % (2 * n)
            out[i][j if j < n else 2 * n - 1 - j] += w
    return out


def smoothed_weights(df: DataFrame, label: str, classes: Sequence[int], sigma: float = 1.0) -> DataFrame:
    """Weight 1 / (smoothed count) per class of a fixed ordered list, relative to the least one."""
    classes = list(classes)
    one = df.agg(*[F.count_if(F.col(label) == F.lit(c)).alias(f"c{i}") for i, c in enumerate(classes)])
    rows = []
    for i, weights in enumerate(smoothing_matrix(len(classes), sigma)):
        smooth = sum((F.col(f"c{j}") * F.lit(w) for j, w in enumerate(weights) if w), F.lit(0.0))
        rows.append(F.struct(F.lit(classes[i]).alias("label"), F.col(f"c{i}").alias("n"), smooth.alias("smoothed")))
    # One row per class of the list.
    long = one.select(F.inline(F.array(*rows)))
    raw = 1.0 / (F.col("smoothed") + 1e-6)
    return long.select("label", "n", "smoothed", (raw / F.min(raw).over(Window.partitionBy())).alias("weight"))


def standardized(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """`(x - mean) / population deviation` per column; a constant column becomes 0.

    Means and deviations of all columns are one scalar subquery, so the rows stay where they are.
    """
    stats = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns
    ]).alias("b")).scalar()
    added = {
        f"{c}{suffix}": F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(F.col(c) - stats[c]["m"], stats[c]["s"]), F.lit(0.0)))
        for c in columns
    }
    return df.withColumns(added)


def median_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers become the column's exact median. The medians of all columns are selected together."""
    from equigauge.operators.quantiles import exact_quantiles

    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])))
    medians = exact_quantiles(long, "value", [0.5], ["name"])
    of = {c: medians.agg(F.max(F.when(F.col("name") == c, F.col("q_0")))).scalar() for c in columns}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), of[c]) for c in columns})
