"""Data quality: completeness, integrity, balance and representation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.functions.bins import equal_count_names
from equigauge.functions.clean import label_text, to_number
from equigauge.functions.ratios import ratio


def _filled(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNotNull() & (F.trim(c) != "")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def completeness(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Filled cells over all cells of the required columns; a column the table lacks counts as empty."""
    present = [c for c in required if c in df.columns]
    counts = [F.count_if(_filled(df, c)).alias(f"filled_{i}") for i, c in enumerate(present)]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    filled = sum((F.col(f"filled_{i}") for i in range(len(present))), F.lit(0).cast("bigint"))
    cells = F.col("n_rows") * len(required)
    return one.select("n_rows", filled.alias("filled"), cells.alias("cells"), ratio(filled, cells).alias("completeness"))


def missing_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty cells per column, long form, from one pass."""
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(~_filled(df, c)).alias(c) for c in columns])
    return one.unpivot(["n_rows"], list(columns), "column_name", "missing")


def integrity(df: DataFrame, required: Sequence[str], target: str, above: Mapping[str, float]) -> DataFrame:
    """Named checks as (check_name, passed, violations): columns present, two target values, no empty keys, ranges."""
    spark = df.sparkSession
    schema_rows = [(f"column:{c}", c in df.columns, int(c not in df.columns)) for c in required]
    static = spark.createDataFrame(schema_rows, "check_name string, passed boolean, violations bigint")
    exprs: list[Column] = []
    if target in df.columns:
        # Two values when the extremes differ and every row equals one of them.
        ends = df.agg(F.struct(F.min(target).alias("lo"), F.max(target).alias("hi")).alias("e")).scalar()
        y = F.col(target)
        exprs.append(F.count_if(y.isNotNull() & (y != ends["lo"]) & (y != ends["hi"])).alias(f"binary:{target}"))
        exprs.append(F.max((ends["lo"] == ends["hi"]).cast("bigint")).alias("_one_value"))
    exprs += [F.count_if(~_filled(df, c)).alias(f"filled:{c}") for c in required if c in df.columns]
    exprs += [
        F.count_if(F.col(c).isNotNull() & ~(F.col(c) > F.lit(v))).alias(f"range:{c}")
        for c, v in above.items() if c in df.columns
    ]
    if not exprs:
        return static
    one = df.agg(*exprs)
    names = [c for c in one.columns if c != "_one_value"]
    if "_one_value" in one.columns:
        binary = f"binary:{target}"
        one = one.withColumn(binary, F.col(binary) + F.coalesce("_one_value", F.lit(1)))
    rows = one.select(*names).unpivot([], names, "check_name", "violations")
    return static.unionByName(rows.select("check_name", (F.col("violations") == 0).alias("passed"), "violations"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value, missing values left out."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select(column, "n", ratio("n", total).alias("share"))


def balance(df: DataFrame, column: str) -> DataFrame:
    """Rarest over commonest value, and the rarest value's share of the rows."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(
        ratio(F.min("n"), F.max("n")).alias("imbalance"),
        F.coalesce(ratio(F.min("n"), F.sum("n")), F.lit(0.0)).alias("minority_share"),
        F.count(F.lit(1)).alias("n_values"),
    )


def group_positive_rates(
    df: DataFrame, target: str, dimension: str, bucket_method: str | None = None, buckets: int = 3,
    positive: float | None = None,
) -> DataFrame:
    """Share of positives among known numeric targets per group, 0 where a group has none.

    Without a given positive value it is the larger one if exactly two numeric values occur, else 1. Numeric
    dimensions may be cut into quantile groups first.
    """
    if dimension not in df.columns:
        raise KeyError(f"dimension column '{dimension}' is not in the table")
    numeric = isinstance(df.schema[dimension].dataType, T.NumericType)
    if bucket_method == "quantiles" and numeric:
        frame = equal_count_names(df, dimension, buckets, "grp")
    else:
        frame = df.withColumn("grp", label_text(dimension, dict(df.dtypes)[dimension]))
    # Few distinct (group, target) pairs: everything below works on these counts.
    pairs = frame.filter(F.col("grp").isNotNull()).groupBy("grp", to_number(target).alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if positive is None:
        values = df.select(to_number(target).alias("y")).filter(F.col("y").isNotNull()).groupBy("y").agg(
            F.count(F.lit(1)).alias("n")
        )
        chosen = values.agg(F.when(F.count(F.lit(1)) == 2, F.max("y")).otherwise(1.0)).scalar()
    else:
        chosen = F.lit(float(positive))
    return pairs.groupBy("grp").agg(
        F.sum("n").alias("n"),
        ratio(
            F.sum(F.when(F.col("y") == chosen, F.col("n")).otherwise(0)),
            F.sum(F.when(F.col("y").isNotNull(), F.col("n")).otherwise(0)), 0.0,
        ).alias("positive_rate"),
    )


def smallest_positive_rate(rates: DataFrame) -> DataFrame:
    """The least group rate, 0 without groups."""
    return rates.agg(F.coalesce(F.min("positive_rate"), F.lit(0.0)).alias("value"), F.sum("n").alias("n_rows"))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per text column; ties go to the lesser value.

    The columns are turned into long rows first, so the number of jobs does not grow with their number.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]))).filter(F.col("value").isNotNull())
    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("minus"), "value"))
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_distinct"), best.alias("best")
    ).select("column_name", "n", "n_distinct", F.col("best.value").alias("top"), (-F.col("best.minus")).alias("top_n"))
