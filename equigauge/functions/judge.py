"""Comparing a value with its limit, and wording the outcome."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of each comparison.
GREATER = ("gt", ">")
LESS = ("lt", "<")
AT_LEAST = ("gte", ">=", "ge")
AT_MOST = ("lte", "<=", "le")
EQUAL = ("eq", "==", "=")
OPERATORS = (*GREATER, *LESS, *AT_LEAST, *AT_MOST, *EQUAL)

# Band limits by metric family, as (limit, band) in order of testing.
GAP_BANDS = ((0.10, "low"), (0.20, "medium"))
SIZE_BANDS = ((5.0, "low"), (2.0, "medium"))
SHARE_BANDS = ((0.70, "low"), (0.50, "medium"))


def compare(value: Column, operator: Column, threshold: Column) -> Column:
    """Whether `value operator threshold` holds; NULL if the value or the operator is unknown."""
    return (
        F.when(operator.isin(*GREATER), value > threshold)
        .when(operator.isin(*LESS), value < threshold)
        .when(operator.isin(*AT_LEAST), value >= threshold)
        .when(operator.isin(*AT_MOST), value <= threshold)
        .when(operator.isin(*EQUAL), value == threshold)
    )


def symbol(operator: Column) -> Column:
    """The operator as a sign."""
    return (
        F.when(operator.isin(*GREATER), ">").when(operator.isin(*LESS), "<")
        .when(operator.isin(*AT_LEAST), ">=").when(operator.isin(*AT_MOST), "<=")
        .when(operator.isin(*EQUAL), "==").otherwise(operator)
    )


def message(value: Column, operator: Column, threshold: Column) -> Column:
    """`0.1234 < 0.1000`, or the note that there is no value."""
    text = F.format_string("%.4f %s %.4f", value, symbol(operator), threshold)
    return F.when(value.isNull(), F.lit("not evaluated")).otherwise(text)


def risk_band(metric_key: Column, value: Column) -> Column:
    """low / medium / high: small gaps are good, large groups and shares are good."""

    def at_least(bands: tuple) -> Column:
        (first, a), (second, b) = bands
        return F.when(value >= first, a).when(value >= second, b).otherwise("high")

    (g1, a), (g2, b) = GAP_BANDS
    gaps = F.when(value <= g1, a).when(value <= g2, b).otherwise("high")
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(metric_key == "k_anonymity", at_least(SIZE_BANDS))
        .when(metric_key == "data_minimization", at_least(SHARE_BANDS))
        .when(metric_key.rlike("parity|odds|opportunity|equality|closeness"), gaps)
        .otherwise("calculated")
    )


def suspicious(value: Column) -> Column:
    """True for a perfect 0.0 or 1.0."""
    return F.coalesce(value.isin(0.0, 1.0), F.lit(False))


def as_list(text: Column) -> Column:
    """`"['a', 'b']"` and `"a, b"` to an array; NULL stays NULL."""
    bare = F.regexp_replace(text, "[\\[\\]'\" ]", "")
    return F.when(F.length(bare) > 0, F.split(bare, ","))
