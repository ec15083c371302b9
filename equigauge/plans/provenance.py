"""Evidence: fingerprints of tables and records of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Digests of a row, numbers in a digest, parts of a table, and nodes under one of the tree above the parts.
DIGESTS, LANES, PARTS, FAN = 4, 4, 256, 16


def _cell(c: str) -> Column:
    """A cell with its column's name and its length, or a mark for a missing value that no text can have."""
    value = F.col(c).cast("string")
    return F.coalesce(F.concat(F.lit(f"{c}="), F.length(value), F.lit(":"), value), F.lit(f"{c}!"))


def _lanes(columns: Sequence[str]) -> list[Column]:
    """The row as 16 numbers of 64 bits: all bits of four digests of its text."""
    text = F.concat(*map(_cell, columns))
    digests = [F.sha2(F.concat(F.lit(f"{k}|"), text), 256) for k in range(DIGESTS)]
    return [F.conv(F.substring(d, 1 + 16 * lane, 16), 16, 10).cast("decimal(38,0)") for d in digests for lane in range(LANES)]


def part_of(keys: Sequence[str]) -> Column:
    """The part that a key falls in, by its hash."""
    return F.conv(F.substring(F.sha2(F.concat(*map(_cell, keys)), 256), 1, 2), 16, 10).cast("int")


def fingerprint_parts(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """(part, n_rows, part_hash): the leaves, one per part of the rows by `keys`, by all columns where none are given.

    A leaf hashes the sums of the rows' numbers, so it depends on the rows and their repeats but not on their order, and
    tasks only move their sums. As 1024 bits are summed, other rows with the same sums are not found by trying.
    """
    columns = list(columns or df.columns)
    lanes = _lanes(columns)
    rows = df.select(part_of(list(keys or columns)).alias("part"), *(x.alias(f"l{i}") for i, x in enumerate(lanes)))
    sums = [F.sum(f"l{i}").cast("string") for i in range(len(lanes))]
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.concat_ws(",", F.count(F.lit(1)), *sums), 256).alias("part_hash"))


def _root(leaves: DataFrame) -> DataFrame:
    """Rows in all and the hash at the top of the tree. There are at most `PARTS` leaves, which meet in one row."""
    def above(nodes: Column) -> Column:
        """The nodes one level up: each hashes its `FAN` children by number."""
        up = F.array_distinct(F.transform(nodes, lambda x: F.floor(x["at"] / FAN).cast("int")))
        named = lambda x: F.concat(x["at"], F.lit(":"), x["hash"])
        return F.transform(up, lambda k: F.struct(k.alias("at"), F.sha2(F.array_join(F.transform(
            F.filter(nodes, lambda x: F.floor(x["at"] / FAN).cast("int") == k), named), ","), 256).alias("hash")))

    nodes, width = F.array_sort(F.collect_list(F.struct(F.col("part").alias("at"), F.col("part_hash").alias("hash")))), PARTS
    while width > 1:
        nodes, width = above(nodes), width // FAN
    top = F.coalesce(F.try_element_at(nodes, F.lit(1))["hash"], F.sha2(F.lit(""), 256))
    return leaves.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), top.alias("data_hash"))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Row count and the hash at the top of a tree over the parts; it does not depend on the order of the rows."""
    return _root(fingerprint_parts(df, columns, keys))


def changed_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Of the leaves of two versions: part, rows before and after, where they differ."""
    old = before.select("part", F.col("n_rows").alias("rows_before"), F.col("part_hash").alias("_before"))
    new = after.select("part", F.col("n_rows").alias("rows_after"), F.col("part_hash").alias("_after"))
    joined = old.join(new, "part", "full").filter(~F.col("_before").eqNullSafe(F.col("_after")))
    return joined.select("part", F.coalesce("rows_before", F.lit(0)).alias("rows_before"), F.coalesce("rows_after", F.lit(0)).alias("rows_after"))


def run_record(df: DataFrame, run_id: str, mitigation: str = "None", columns: Sequence[str] | None = None) -> DataFrame:
    """One row about a run: time, rows, fingerprint and label."""
    return fingerprint(df, columns).select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("timestamp"), "n_rows", "data_hash",
        F.lit(mitigation).alias("mitigation"),
    )
