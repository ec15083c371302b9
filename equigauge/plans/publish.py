"""Write, audit, publish: rows are staged, audited from the stage, and become visible only when the gate lets them.

A stage is a folder of rows and a manifest. Readers follow the newest entry of a list of versions, which is written last,
so a failed audit or a lost job leaves them on the version before. A run that is staged again replaces its own stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.plans.enforce import gate

_MANIFEST = "run_id string, n_rows long"
_VERSION = "run_id string, n_controls long, version long"


def stage(rows: DataFrame, path: str, run_id: str) -> DataFrame:
    """Store the rows of a run where no reader sees them, and read them back. The manifest is written after them."""
    spark, place = rows.sparkSession, f"{path}/stages/{run_id}"
    rows.write.mode("overwrite").parquet(f"{place}/rows")
    stored = spark.read.schema(rows.schema).parquet(f"{place}/rows")
    stored.agg(F.lit(run_id).alias("run_id"), F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(f"{place}/manifest")
    return stored


def versions(spark: SparkSession, path: str) -> DataFrame:
    """What has been published: version, run_id and the number of controls that were passed."""
    try:
        return spark.read.schema(_VERSION).parquet(f"{path}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSION)


def publish(path: str, run_id: str, results: DataFrame) -> int:
    """Make a staged run visible if all its controls passed, else raise `PolicyViolation`; returns the version."""
    spark = results.sparkSession
    manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/stages/{run_id}/manifest").first()
    if manifest is None or manifest["run_id"] != run_id:
        raise LookupError(f"run {run_id} is not staged")
    gate(results)
    version = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    told = results.agg(F.lit(run_id).alias("run_id"), F.count(F.lit(1)).alias("n_controls"))
    told.write.mode("errorifexists").parquet(f"{path}/versions/version={version}")
    return version


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the newest version, or None where nothing is published."""
    newest = versions(spark, path).orderBy(F.desc("version")).first()
    return None if newest is None else spark.read.parquet(f"{path}/stages/{newest['run_id']}/rows")
