"""Metrics with a state of their own: updated by batches inside tasks, merged by key, and finished to a number."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from equigauge.session import ship_package

#: Keys whose state a task holds before it hands them on.
HELD_KEYS = 10_000


class Accumulator(Protocol):
    """What a metric brings. A state is an array of numbers of fixed length; merging must not depend on the order."""

    columns: Sequence[str]

    def zero(self) -> np.ndarray: ...

    def update(self, state: np.ndarray, *columns: np.ndarray) -> np.ndarray: ...

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray: ...

    def finish(self, state: np.ndarray) -> float | None: ...


def _key_schema(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def _handed_on(keys: list, states: list, names: Sequence[str], kinds: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in keys], kinds.field(c).type) for i, c in enumerate(names)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([s.tobytes() for s in states], pa.binary())], [*names, "state"])


def accumulated(df: DataFrame, keys: Sequence[str], accumulator: Accumulator) -> DataFrame:
    """(keys..., value) of an accumulator per group. Rows with a NULL key are left out.

    Tasks keep one state per key of their rows, so a group of any number of rows moves one state per task; states are dealt
    by key and merged there.
    """
    names, fields = list(keys), _key_schema(df, keys)
    held = T.StructType([*fields, T.StructField("state", T.BinaryType())])
    told = T.StructType([*fields, T.StructField("value", T.DoubleType())])
    packed = cloudpickle.dumps(accumulator)
    ship_package(df.sparkSession)

    def updated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric, states = cloudpickle.loads(packed), {}
        for batch in batches:
            frame = batch.to_pandas()
            for key, rows in frame.groupby(names, sort=False):
                state = states.get(key)
                state = metric.zero() if state is None else state
                states[key] = metric.update(state, *(rows[c].to_numpy() for c in metric.columns))
            if len(states) > HELD_KEYS:
                yield _handed_on(list(states), list(states.values()), names, batch.schema)
                states = {}
        if states:
            yield _handed_on(list(states), list(states.values()), names, batch.schema)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        metric, states = cloudpickle.loads(packed), {}
        kind = metric.zero().dtype
        for batch in batches:
            for *key, state in zip(*(c.to_pylist() for c in batch.columns)):
                state, key = np.frombuffer(state, kind), tuple(key)
                states[key] = metric.merge(states[key], state) if key in states else state
        if states:
            columns = [pa.array([k[i] for k in states], batch.schema.field(c).type) for i, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([metric.finish(s) for s in states.values()], pa.float64())], [*names, "value"])

    known = df.select(*names, *accumulator.columns).na.drop(subset=names)
    partial = known.mapInArrow(updated, held)
    return partial.repartition(*names).mapInArrow(merged, told)


class CalibrationError:
    """Mean gap between score and share of positives over equal bins of the score, weighted by rows."""

    def __init__(self, score: str, target: str, bins: int = 10):
        self.columns, self.bins = (score, target), bins

    def zero(self) -> np.ndarray:
        return np.zeros(3 * self.bins)

    def update(self, state: np.ndarray, score: np.ndarray, target: np.ndarray) -> np.ndarray:
        known = ~(np.isnan(score.astype(float)) | np.isnan(target.astype(float)))
        score, target = score[known].astype(float), target[known].astype(float)
        at = np.clip((score * self.bins).astype(int), 0, self.bins - 1)
        add = [np.bincount(at, w, self.bins) for w in (None, score, target)]
        return state + np.concatenate(add)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a + b

    def finish(self, state: np.ndarray) -> float | None:
        n, score, target = np.split(state, 3)
        return float(np.abs(score - target).sum() / n.sum()) if n.sum() else None
