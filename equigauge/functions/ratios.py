"""Ratios that never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column | str, den: Column | str, zero: float | None = None) -> Column:
    """`num / den`; `zero` (NULL unless given) on an empty denominator."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if zero is None else F.coalesce(out, F.lit(float(zero)))


def harmonic(a: Column, b: Column) -> Column:
    """Harmonic mean, 0 when both are 0."""
    return ratio(2 * a * b, a + b, 0.0)


def relative_drop(whole: Column, part: Column) -> Column:
    """`(whole - part) / whole`; 0 if the part is missing or the whole is 0."""
    return ratio(whole - part, whole, 0.0)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Aggregate: correlation over rows where both are known; NULL on zero variance."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull()
    sx, sy = F.stddev_pop(F.when(both, x)), F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)
