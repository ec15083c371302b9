"""Joining rows back to the group that each belongs to, where a group may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of more rows than both of these are large; there are at most `MOST_LARGE` of them, whatever the table.
LEAST_ROWS, MOST_LARGE = 1_000, 100_000


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """`rows` with the columns of their group. `groups` has one row per `key`, and `size`, how many of the `n_rows` it holds.

    The large groups, whose number is bounded by their size, are sent to all tasks, so none of them gathers in one; the
    others meet their rows by the key. Rows without a group are left out.
    """
    large = F.col(size) > max(LEAST_ROWS, n_rows // MOST_LARGE)
    own = [c for c in groups.columns if c != key]
    hot = groups.filter(large).select(F.col(key).alias("hot_key"), F.struct(*own).alias("hot_group"))
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left").drop("hot_key")
    at_once = met.filter("hot_group IS NOT NULL").select(*rows.columns, "hot_group.*")
    rest = met.filter("hot_group IS NULL").drop("hot_group").join(groups.filter(~large), key).select(*rows.columns, *own)
    return at_once.union(rest)
