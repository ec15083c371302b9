"""Cleaning and recoding of single columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Double, or NULL for text that is no number and for NaN."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_float(c: Column | str, default: float = 0.0) -> Column:
    """Double with a default for missing or unreadable values."""
    return F.coalesce(to_number(c), F.lit(default))


def trimmed_text(c: Column | str, default: str = "Unknown") -> Column:
    """Trimmed text; missing and empty become `default`."""
    return F.coalesce(F.nullif(F.trim(_col(c).cast("string")), F.lit("")), F.lit(default))


def age_in_years(c: Column | str) -> Column:
    """Years from text such as `055Y` or `60`; anything else is NULL."""
    digits = F.regexp_extract(F.trim(_col(c).cast("string")), "^([0-9]+)Y?$", 1)
    return digits.try_cast("int")


def binary_label(c: Column | str, positive: object = 1) -> Column:
    """1 where the column equals `positive`, 0 elsewhere, NULL stays NULL."""
    return (_col(c) == F.lit(positive)).cast("int")


def equals_text(c: Column | str, text: str) -> Column:
    """1 where the trimmed, lower-cased text equals `text`."""
    return (F.lower(F.trim(_col(c))) == F.lit(text)).cast("int")


def by_membership(c: Column | str, members: Iterable[object], inside: object, outside: object) -> Column:
    """`inside` for listed values, `outside` for all others, missing ones included."""
    return F.when(_col(c).isin(*members), F.lit(inside)).otherwise(F.lit(outside))


def by_mapping(c: Column | str, mapping: Mapping[object, object], default: object = "Unknown") -> Column:
    """Dictionary recode with a default."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c)), F.lit(default))


def group_key(*cols: Column | str) -> Column:
    """Composite group name `a_b`; NULL if any part is NULL."""
    parts = [_col(c).cast("string") for c in cols]
    known = parts[0].isNotNull()
    for part in parts[1:]:
        known = known & part.isNotNull()
    return F.when(known, F.concat_ws("_", *parts))


def rescaled(c: Column | str, slope: Column | str | float = 1.0, intercept: Column | str | float = 0.0) -> Column:
    """`value * slope + intercept`, NaN and NULL become 0. Missing slope is 1, missing intercept 0."""
    k = F.lit(slope) if isinstance(slope, float) else F.coalesce(_col(slope), F.lit(1.0))
    b = F.lit(intercept) if isinstance(intercept, float) else F.coalesce(_col(intercept), F.lit(0.0))
    out = _col(c) * k + b
    return F.coalesce(F.nanvl(out.cast("double"), F.lit(0.0)), F.lit(0.0))


def above(c: Column | str, threshold: float) -> Column:
    """1 where the value is strictly above the threshold."""
    return (_col(c) > F.lit(threshold)).cast("int")


def argmax_index(scores: Column | str) -> Column:
    """Zero-based position of the largest score, the first one on ties."""
    return (F.array_position(_col(scores), F.array_max(_col(scores))) - 1).cast("int")


def finite(c: Column | str) -> Column:
    """NaN becomes NULL, so that averages skip it."""
    return F.when(~F.isnan(_col(c)), _col(c))


def label_text(c: Column | str, dtype: str) -> Column:
    """Text form in which `1`, `1.0` and `'1'` agree, so targets and predictions of different types compare."""
    c = _col(c)
    if dtype in ("double", "float") or dtype.startswith("decimal"):
        wide = c.cast("double")
        whole = wide.try_cast("bigint")
        text = F.when(whole == wide, whole.cast("string")).otherwise(wide.cast("string"))
        return F.when(~F.isnan(wide), text)
    if dtype == "boolean":
        return c.cast("int").cast("string")
    return c.cast("string")
