"""Session settings and the place where data leaves a plan: shared folders."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "equigauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC. Give `master` and sizes only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording the Python call site of every expression costs more than building the expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_folders: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster names in `spark.checkpoint.dir`, else under the warehouse.

    On a cluster a warehouse on the local disk, which is Spark's default, is refused, as executors would not find each
    other's files there. `release` removes what the process has made; it runs at exit too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
        if base.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _folders.append((spark, path))
    return path


def release(down_to: int = 0) -> None:
    """Remove the folders made so far, but for the first `down_to`. Frames that still read from them are then of no use."""
    while len(_folders) > down_to:
        _remove(*_folders.pop())


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


atexit.register(release)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Within a long session: what is stored inside the block is removed at its end, when its results have been written."""
    before = len(_folders)
    try:
        yield
    finally:
        release(before)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Only the archive is built in the driver's temporary folder; Spark's file server hands it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="equigauge-")
        context.addPyFile(shutil.make_archive(f"{folder}/equigauge", "zip", os.path.dirname(here), os.path.basename(here)))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _shipped.add(context.applicationId)


def settle(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back, so later plans start from stored rows."""
    path = shared_folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def settled(df: DataFrame) -> Iterator[DataFrame]:
    """The same for the length of a block: what is stored is removed at its end, when nothing reads it any more."""
    stored = settle(df)
    place = _folders[-1]
    try:
        yield stored
    finally:
        _remove(*place)
        _folders.remove(place)


def attach(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a lookup that is usually tiny to a large table.

    The lookup is computed once and stored, so Spark knows its size when it plans the join: below its threshold in bytes it
    is broadcast and the large side is not shuffled; beyond it both sides are, and skewed keys are split at run time.
    """
    return df.join(settle(lookup), on, how)
