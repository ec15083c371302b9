"""k-anonymity, l-diversity, t-closeness and data minimisation.

All three group measures start from the same cells: counts per combination of quasi-identifiers and sensitive value.
The cells spread over all keys, so one large group of look-alike rows is never gathered in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.functions.ratios import ratio
from equigauge.operators.running import last_at_most, scan, unplaced
from equigauge.session import settle


def cells(df: DataFrame, quasi_identifiers: Sequence[str], sensitive: str | None = None) -> DataFrame:
    """Counts per quasi-identifier group, and per sensitive value if one is given. Rows with an unknown key drop out."""
    keys = list(quasi_identifiers)
    known = df.na.drop(subset=keys)
    if sensitive is None:
        return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return known.groupBy(*keys, F.col(sensitive).alias("s")).agg(F.count(F.lit(1)).alias("n"))


def k_anonymity(df: DataFrame, quasi_identifiers: Sequence[str]) -> DataFrame:
    """Smallest group size, 0 for an empty table."""
    return cells(df, quasi_identifiers).agg(
        F.coalesce(F.min("n"), F.lit(0)).cast("bigint").alias("k"),
        F.count(F.lit(1)).alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )


def l_diversity(df: DataFrame, quasi_identifiers: Sequence[str], sensitive: str) -> DataFrame:
    """Fewest distinct sensitive values in a group; unknown values do not count as a value."""
    per_group = cells(df, quasi_identifiers, sensitive).groupBy(*quasi_identifiers).agg(
        F.count("s").alias("distinct_values"), F.sum("n").alias("n")
    )
    return per_group.agg(
        F.coalesce(F.min("distinct_values"), F.lit(0)).cast("bigint").alias("l"),
        F.count(F.lit(1)).alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )


def group_distances(df: DataFrame, quasi_identifiers: Sequence[str], sensitive: str, ordered: bool = False) -> DataFrame:
    """Earth mover's distance between each group's sensitive values and the whole table's.

    The table is read once, for the cells; sizes of groups and values are sums of those.
    """
    keys = list(quasi_identifiers)
    known = df.select(*keys, F.col(sensitive).alias("s")).na.drop(subset=["s"])
    cell = settle(cells(known, keys, "s"))
    whole = cell.groupBy("s").agg(F.sum("n").alias("n_value"))
    # Cells of a hot group are spread by value, so its size meets them in a join that Spark may split.
    sized = cell.join(cell.groupBy(*keys).agg(F.sum("n").alias("n_group")), keys)
    return _ordered(sized, whole, keys) if ordered else _unordered(sized, whole, keys)


def _unordered(cell: DataFrame, whole: DataFrame, keys: list[str]) -> DataFrame:
    """Half the absolute differences. Values a group lacks add up to one minus the table share of those it has."""
    total = whole.agg(F.sum("n_value")).scalar()
    share, base = ratio("n", "n_group"), ratio("n_value", total)
    return cell.join(whole, "s").groupBy(*keys).agg(
        F.max("n_group").alias("n"), (0.5 * (1.0 + F.sum(F.abs(share - base) - base))).alias("distance")
    )


def _ordered(cell: DataFrame, whole: DataFrame, keys: list[str]) -> DataFrame:
    """Mean absolute gap between the cumulative shares, over the m - 1 steps of the ordered value domain.

    A group's cumulative share only changes at the values it has. Between two of them it is a constant c, and the sum
    of |c - Q(i)| over that run of positions follows from prefix sums of the table's cumulative share Q: the
    positions up to t, the last one with Q <= c, contribute c - Q and the rest Q - c. So each stored cell needs one
    lookup of t by c and no missing cell is ever materialised. The sensitive column must be numeric.
    """
    steps = settle(_value_steps(whole))
    m, end = steps.agg(F.max("i").alias("m")).scalar(), steps.agg(F.max("through").alias("end")).scalar()
    placed = cell.join(steps.select("s", "i", "before"), "s")
    own = scan(placed, keys, ["i"], sums={"upto": "n"}, previous={"i_before": "i"}, following={"i_next": "i", "before_after": "before"})
    runs = unplaced(own).select(
        *keys, "n_group", "i", "before", ratio("upto", "n_group").alias("c"), F.coalesce(F.col("i_next") - 1, m).alias("last"),
        F.coalesce("before_after", end).alias("before_next"), F.col("i_before").isNull().alias("first"),
    )
    # A level occurs in many groups; each distinct one is looked up once.
    marks = steps.select(F.col("q").alias("c"), "i", F.col("through").alias("t_through"))
    found = last_at_most(runs.select("c").distinct(), marks, "c", ["t_through"]).select(
        "c", F.coalesce("i", F.lit(0)).alias("t"), F.coalesce("t_through", F.lit(0.0)).alias("t_through")
    )
    run = runs.join(found, "c")
    t = F.least(F.greatest(F.col("t"), F.col("i") - 1), F.col("last"))
    through_t = F.when(F.col("t") < F.col("i"), F.col("before")).when(
        F.col("t") >= F.col("last"), F.col("before_next")
    ).otherwise(F.col("t_through"))
    below = F.col("c") * (t - F.col("i") + 1) - (through_t - F.col("before"))
    above = (F.col("before_next") - through_t) - F.col("c") * (F.col("last") - t)
    head = F.when(F.col("first"), F.col("before")).otherwise(0.0)
    distance = F.try_divide(F.sum(below + above + head), (F.coalesce(m, F.lit(1)) - 1).cast("double"))
    return run.groupBy(*keys).agg(F.max("n_group").alias("n"), F.coalesce(distance, F.lit(0.0)).alias("distance"))


def _value_steps(whole: DataFrame) -> DataFrame:
    """Per distinct sensitive value in order: position i, table share Q(i), sums of Q before and through i."""
    total = whole.agg(F.sum("n_value")).scalar()
    placed = scan(whole.withColumn("one", F.lit(1)), [], ["s"], sums={"upto": "n_value", "i": "one"})
    q = placed.select("*", ratio("upto", total).alias("q")).withColumn("i", F.col("i").cast("int"))
    through = unplaced(scan(q, [], ["s"], sums={"through": "q"}))
    return through.select("s", "i", "q", "through", (F.col("through") - F.col("q")).alias("before"))


def t_closeness(df: DataFrame, quasi_identifiers: Sequence[str], sensitive: str, ordered: bool = False) -> DataFrame:
    """Largest group distance, 0 for an empty table."""
    per_group = group_distances(df, quasi_identifiers, sensitive, ordered)
    return per_group.agg(
        F.coalesce(F.max("distance"), F.lit(0.0)).alias("t"),
        F.count(F.lit(1)).alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )


def data_minimization(df: DataFrame, sensitive_columns: Sequence[str]) -> float:
    """One minus the share of columns that are sensitive; read off the schema, no rows are touched."""
    present = [c for c in sensitive_columns if c in df.columns]
    return 1.0 - len(present) / len(df.columns) if df.columns else 0.0
