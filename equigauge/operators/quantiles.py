"""Exact quantiles of large columns.

Spark's `percentile` keeps every distinct value of a group in one buffer. Here a sketch first brackets each wanted
order statistic, one aggregation counts what lies below the bracket, and only values inside it are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.functions.clean import finite
from equigauge.operators.running import scan
from equigauge.session import attach

ACCURACY = 20_000
#: Share of the rows on each side of a wanted rank that a bracket holds at least; the sketch is an eighth of it exact. A
#: bracket of few rows is one of `LEVELS` wider ones, each `WIDER` times as wide, or the whole range.
MARGIN = 8.0 / ACCURACY
WIDER, LEVELS = 4, 6
#: Rows on each side that a bracket holds at least.
LEAST = 2


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), name: str = "q"
) -> DataFrame:
    """Quantiles with linear interpolation as (keys..., n, q_0, q_1, ...); NULL and NaN are skipped.

    All groups are selected together: a sketch gives each a bracket around every wanted rank, values outside are counted
    only, and those inside are ranked by a scan over ranges, so a group of nearly all rows spreads over tasks. A group
    whose bracket should miss its rank is ranked whole.
    """
    keys = list(keys)
    values = df.select(*keys, finite(F.col(value).cast("double")).alias("v")).filter(F.col("v").isNotNull())
    for key in keys:
        values = values.filter(F.col(key).isNotNull())
    # What is ranked is stored, so looking for misses first costs little.
    found = _selected(values, probs, keys, _brackets(values, probs, keys))
    missed = found.filter("missed")
    if not missed.isEmpty():
        again = values.join(missed.select(*keys), keys, "left_semi") if keys else values
        whole = again.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo0"), F.max("v").alias("hi0"))
        ends = [F.col(f"{end}0").alias(f"{end}{i}") for i in range(len(probs)) for end in ("lo", "hi")]
        found = found.filter("NOT missed").union(_selected(again, probs, keys, whole.select(*keys, "n", *ends)))
    return found.select(*keys, "n", *(F.col(f"q{i}").alias(f"{name}_{i}") for i in range(len(probs))))


def _brackets(values: DataFrame, probs: Sequence[float], keys: list[str]) -> DataFrame:
    """Per group its rows and the bracket (lo, hi) around each rank."""
    widths = [MARGIN * WIDER**level for level in range(LEVELS)]
    around = sorted({min(max(p + side * w, 0.0), 1.0) for p in probs for w in widths for side in (-1, 1)})
    place = {q: k for k, q in enumerate(around)}
    sketched = values.groupBy(*keys).agg(
        F.percentile_approx("v", F.array(*map(F.lit, around)), ACCURACY).alias("ends"),
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"),
    ).filter("n > 0")

    def end(p: float, side: int) -> Column:
        chosen = F.when(F.lit(False), F.lit(None).cast("double"))
        for w in widths:
            q = min(max(p + side * w, 0.0), 1.0)
            at = F.col("least") if q <= 0 else F.col("most") if q >= 1 else F.col("ends")[place[q]]
            chosen = chosen.when(F.col("n") * w >= LEAST, at)
        return chosen.otherwise(F.col("least") if side < 0 else F.col("most"))
    return sketched.select(*keys, "n", *(end(p, side).alias(f"{'lo' if side < 0 else 'hi'}{i}") for i, p in enumerate(probs) for side in (-1, 1)))


def _selected(values: DataFrame, probs: Sequence[float], keys: list[str], brackets: DataFrame) -> DataFrame:
    """Per group n, the quantiles q0, q1, ... and whether a bracket missed its rank."""
    k = len(probs)
    fields = ["n", *(f"{end}{i}" for i in range(k) for end in ("lo", "hi"))]
    if keys:
        placed = attach(values, brackets, keys)
    else:
        one, types = brackets.select(*fields).first(), dict(brackets.dtypes)
        placed = values.select("v", *[F.lit(one[c] if one else None).cast(types[c]).alias(c) for c in fields])

    # A value inside a bracket stays; all others fold into the end of the last bracket below them, marked as a gap.
    inside, below = F.lit(False), F.lit(-math.inf)
    for i in range(k):
        inside = inside | F.col("v").between(F.col(f"lo{i}"), F.col(f"hi{i}"))
        below = F.greatest(below, F.when(F.col(f"hi{i}") < F.col("v"), F.col(f"hi{i}")))
    kept = placed.select(*keys, "n", F.when(inside, F.col("v")).otherwise(below).alias("at"), (~inside).alias("gap"))
    counted = kept.groupBy(*keys, "n", "at", "gap").agg(F.count(F.lit(1)).alias("c"))
    ranked = scan(counted, keys, ["at", "gap"], sums={"upto": "c"})
    found = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        for side, rank in (("a", F.floor(pos)), ("b", F.ceil(pos))):
            found.append(F.min(F.when(F.col("upto") > rank, F.struct("upto", "at", "gap"))).alias(f"{side}{i}"))
    one = ranked.groupBy(*keys, "n").agg(*found)
    missed, out = F.lit(False), []
    for i, p in enumerate(probs):
        a, b, pos = F.col(f"a{i}"), F.col(f"b{i}"), F.lit(float(p)) * (F.col("n") - 1)
        missed = missed | F.coalesce(a["gap"] | b["gap"], F.lit(True))
        out.append((a["at"] + (b["at"] - a["at"]) * (pos - F.floor(pos))).alias(f"q{i}"))
    return one.select(*keys, "n", *out, missed.alias("missed"))


def five_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum per group, with the box-plot whiskers at 1.5 times the quartile range."""
    quartiles = exact_quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], [group])
    named = quartiles.select(
        group, "n", F.col("q_0").alias("lowest"), F.col("q_1").alias("q1"), F.col("q_2").alias("median"),
        F.col("q_3").alias("q3"), F.col("q_4").alias("highest"),
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    rows = attach(df.filter(F.col(value).isNotNull()).select(group, value), named, [group])
    return rows.groupBy(group, "n", "lowest", "q1", "median", "q3", "highest").agg(
        F.min(F.when(F.col(value) >= F.col("q1") - reach, F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col(value) <= F.col("q3") + reach, F.col(value))).alias("whisker_high"),
    )


def quantile_of(df: DataFrame, value: str, prob: float) -> Column:
    """One exact quantile as a scalar subquery."""
    return exact_quantiles(df, value, [prob]).select("q_0").scalar()
