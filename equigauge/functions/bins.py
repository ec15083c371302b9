"""Binning of numbers into ordered, right-closed intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.functions.clean import to_number
from equigauge.operators.quantiles import exact_quantiles


def _chain(c: Column, edges: Sequence[float], outputs: Sequence[object], lowest: bool = False) -> Column:
    out = None
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        inside = (c >= lo) if lowest and k == 0 else (c > lo)
        test = inside & (c <= hi)
        out = F.when(test, F.lit(outputs[k])) if out is None else out.when(test, F.lit(outputs[k]))
    return out


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval `(lo, hi]` the value falls in; outside the edges NULL."""
    return _chain(F.col(c) if isinstance(c, str) else c, edges, labels)


def cut_index(c: Column | str, edges: Sequence[float]) -> Column:
    """Ordinal of the interval, from 1."""
    return _chain(F.col(c) if isinstance(c, str) else c, edges, list(range(1, len(edges))))


def interval_name(lo: object, hi: object, closed_left: bool = False) -> str:
    return f"{'[' if closed_left else '('}{lo}, {hi}]"


def equal_width(df: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    """Ordinal 1..bins of equally wide intervals between the smallest and the largest value.

    The two bounds are a scalar subquery, so the table itself is not shuffled.
    """
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b")).scalar()
    x = F.col(column)
    width = (bounds["hi"] - bounds["lo"]) / F.lit(float(bins))
    index = F.least(F.greatest(F.ceil(F.try_divide(x - bounds["lo"], width)), F.lit(1)), F.lit(bins))
    flat = F.when(x.isNotNull() & (width == 0), F.lit(1))
    return df.withColumn(out, F.when(x.isNotNull() & (width > 0), index).otherwise(flat).cast("int"))


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Distinct edges of equally filled intervals, smallest and largest value included."""
    probs = [k / bins for k in range(bins + 1)]
    row = exact_quantiles(df.select(to_number(column).alias("v")), "v", probs).first()
    if row is None:
        return []
    return sorted({row[f"q_{i}"] for i in range(bins + 1)})


def equal_count(df: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    """Ordinal of the quantile interval; duplicate edges are merged and the lowest value is included."""
    edges = quantile_edges(df, column, bins)
    if len(edges) < 2:
        return df.withColumn(out, F.lit(None).cast("int"))
    return df.withColumn(out, _chain(to_number(column), edges, list(range(1, len(edges))), lowest=True))


def equal_count_names(df: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    """As `equal_count`, with the interval written out as the group name."""
    edges = quantile_edges(df, column, bins)
    if len(edges) < 2:
        return df.withColumn(out, F.lit(None).cast("string"))
    names = [interval_name(lo, hi, k == 0) for k, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    return df.withColumn(out, _chain(to_number(column), edges, names, lowest=True))
