"""Audit frames: binding columns to roles and preparing a table for an audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.operators.running import scan, unplaced
from equigauge.session import settle


def rename_by_position(df: DataFrame, names: Sequence[str], prefix: str = "Attribute") -> DataFrame:
    """Give the generic columns their real names, only when their number matches."""
    generic = [c for c in df.columns if c.startswith(prefix)]
    if len(generic) != len(names):
        return df
    return df.withColumnsRenamed(dict(zip(generic, names)))


def bind_roles(df: DataFrame, roles: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Narrow projection of the role columns under their role names, plus `keep`."""
    return df.select(*keep, *[F.col(physical).alias(role) for role, physical in roles.items()])


def pick_column(df: DataFrame, *candidates: str) -> str | None:
    """The first candidate that the table has."""
    return next((c for c in candidates if c in df.columns), None)


def ensure_column(df: DataFrame, name: str, default: object) -> DataFrame:
    """Add a constant column where it is missing."""
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def drop_known(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns that would leak the label; names the table lacks are ignored."""
    return df.drop(*names)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in without]


def side_by_side(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Features and labels as one table, joined on an explicit key."""
    return features.join(labels, key)


def reattach(predictions: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Bring protected attributes back to scored rows by their stable key."""
    return predictions.join(source.select(key, *columns), key)


def with_text_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.col(key).cast("string"))


def left_metadata(results: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Results with metadata, keys compared as text. Neither side is assumed small."""
    return with_text_key(results, key).join(with_text_key(metadata, key), key, "left")


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no stored result yet."""
    return with_text_key(todo, key).join(with_text_key(done, key).select(key), key, "left_anti")


def register_absent(existing: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """`existing` plus the rows of `new` whose key it lacks."""
    return existing.unionByName(new.join(existing.select(key), key, "left_anti").select(*existing.columns))


def combine(*results: DataFrame, phases: Sequence[str] | None = None) -> DataFrame:
    """Result sets of several audits in one table, with the phase each came from."""
    out = None
    for i, df in enumerate(results):
        if phases is not None:
            df = df.withColumn("phase", F.lit(phases[i]))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


#: Levels of all columns that may become columns of a plan.
MOST_LEVELS = 1_000


def one_hot(
    df: DataFrame, columns: Sequence[str], drop_first: bool = False, levels: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """A 0/1 column `name_level` per level in place of each text column; missing and unseen values have none set.

    `levels` names the levels per column; without it those of all columns come from one pass. More than `MOST_LEVELS` of
    them are refused: such categories belong in `one_hot_sparse`.
    """
    named = {c: list(levels[c]) for c in columns} if levels is not None else _levels(df, columns)
    coded = [
        F.coalesce((F.col(c).cast("string") == F.lit(level)).cast("int"), F.lit(0)).alias(f"{c}_{level}")
        for c in columns for level in named[c][1 if drop_first else 0:]
    ]
    return df.select(*[c for c in df.columns if c not in columns], *coded)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("level")) for c in columns])
    return df.select(F.inline(entries)).filter(F.col("level").isNotNull()).distinct()


def _levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    found = _long(df, columns).limit(MOST_LEVELS + 1).collect()
    if len(found) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} levels in {', '.join(columns)}; use one_hot_sparse")
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for name, level in sorted(tuple(r) for r in found):
        levels[name].append(level)
    return levels


def level_positions(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> DataFrame:
    """(name, level, position) of every level, by name and level in order; a dropped first level has no position."""
    entries = _long(df, columns).withColumn("one", F.lit(1).cast("long"))
    within = scan(entries, ["name"], ["level"], sums={"turn": "one"})
    kept = unplaced(within).withColumn("counts", (F.col("turn") > (1 if drop_first else 0)).cast("long"))
    numbered = unplaced(scan(kept, [], ["name", "level"], sums={"upto": "counts"}))
    return numbered.select("name", "level", F.when(F.col("counts") == 1, F.col("upto") - 1).alias("position"))


def one_hot_sparse(df: DataFrame, columns: Sequence[str], drop_first: bool = False, out: str = "set_positions") -> DataFrame:
    """`df` without the text columns, and the sorted positions of the levels that each row has, for any number of levels.

    The table of positions is stored and joined per column; no level becomes a column, and none is collected.
    """
    positions = settle(level_positions(df, columns, drop_first))
    joined = df
    for i, c in enumerate(columns):
        mine = positions.filter(F.col("name") == c).select(F.col("level").alias(f"_level{i}"), F.col("position").alias(f"_at{i}"))
        joined = joined.join(mine, F.col(c).cast("string") == F.col(f"_level{i}"), "left")
    at = F.array_sort(F.array_compact(F.array(*[F.col(f"_at{i}") for i in range(len(columns))])))
    return joined.select(*[c for c in df.columns if c not in columns], at.alias(out))
