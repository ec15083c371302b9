"""Training and scoring with Spark ML, audited as it goes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from equigauge.plans.enforce import AuditRun, enforce
from equigauge.plans.publish import publish, stage
from equigauge.session import settle, shared_folder


def feature_stages(numeric: Sequence[str], categorical: Sequence[str] = (), drop_first: bool = False) -> list:
    """Median imputation and scaling of numbers, one-hot columns for categories.

    With `drop_first` the alphabetically first level has no column and a level unseen in training is an error: indexing
    in descending order makes the first level the last one, which the encoder drops. Otherwise every level has a column
    and unseen levels share one more.
    """
    filled = [f"{c}__filled" for c in numeric]
    stages: list = []
    parts: list[str] = []
    if numeric:
        stages += [
            Imputer(strategy="median", inputCols=list(numeric), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="__numbers"),
            StandardScaler(withMean=True, withStd=True, inputCol="__numbers", outputCol="__scaled"),
        ]
        parts.append("__scaled")
    if categorical:
        indexed = [f"{c}__index" for c in categorical]
        coded = [f"{c}__code" for c in categorical]
        stages += [
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, stringOrderType="alphabetDesc",
                handleInvalid="error" if drop_first else "keep",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=drop_first),
        ]
        parts += coded
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


class AuditedModel:
    """A logistic regression whose data is audited on fit and whose predictions are audited on predict."""

    def __init__(
        self, controls: Sequence, roles: dict[str, str], target: str, numeric: Sequence[str],
        categorical: Sequence[str] = (), weight: str | None = None, positive: object = 1,
    ):
        self.controls, self.roles, self.target, self.positive = list(controls), dict(roles), target, positive
        self.numeric, self.categorical, self.weight = list(numeric), list(categorical), weight
        self.model: PipelineModel | None = None
        self.data_audit: AuditRun | None = None
        self.last_audit: AuditRun | None = None
        self.observed: Observation | None = None

    def fit(self, train: DataFrame) -> AuditedModel:
        """Fit, after an audit of those controls that need no prediction."""
        roles = {r: c for r, c in self.roles.items() if r != "prediction"}
        about_data = [c for c in self.controls if not c.about_predictions]
        self.data_audit = enforce(train, about_data, target=self.target, positive=self.positive, phase="pre", **roles)
        weights = {"weightCol": self.weight} if self.weight else {}
        # Every stage and every iteration reads the training rows, so what they need is stored once.
        used = [self.target, *self.numeric, *self.categorical, *weights.values()]
        train = settle(train.select(*dict.fromkeys(used)))
        classifier = LogisticRegression(
            featuresCol="features", labelCol=self.target, predictionCol="prediction", maxIter=100, **weights
        )
        fitted = Pipeline(stages=[*feature_stages(self.numeric, self.categorical), classifier]).fit(train)
        # The stored form leaves out the training summary, which holds the session and cannot be sent to tasks.
        path = shared_folder(train.sparkSession, "model")
        fitted.save(path)
        self.model = PipelineModel.load(path)
        return self

    def _scored(self, rows: DataFrame) -> DataFrame:
        if self.model is None:
            raise RuntimeError("fit the model before predicting")
        helpers = [c for c in self.model.transform(rows.limit(0)).columns if "__" in c and c not in rows.columns]
        scored = self.model.transform(rows).drop(*helpers, "features", "rawPrediction", "probability")
        return scored.withColumn("prediction", F.col("prediction").cast("int"))

    def _audited(self, stored: DataFrame) -> None:
        self.last_audit = enforce(
            stored, self.controls, target=self.target, prediction="prediction", positive=self.positive, phase="post",
            **{r: c for r, c in self.roles.items() if r != "prediction"},
        )

    def predict(self, rows: DataFrame) -> DataFrame:
        """Scored rows, stored, so they are scored once; `last_audit` holds the results over them.

        The global rates are observed on the way, at no extra pass.
        """
        scored = self._scored(rows)
        self.observed = Observation()
        stored = settle(scored.observe(
            self.observed,
            F.count(F.lit(1)).alias("n_rows"),
            F.avg((F.col("prediction") == F.col(self.target)).cast("double")).alias("accuracy"),
            F.avg((F.col("prediction") == F.lit(self.positive)).cast("double")).alias("selection_rate"),
        ))
        self._audited(stored)
        return stored

    def publish(self, rows: DataFrame, path: str, run_id: str) -> int:
        """Score `rows` into a stage, audit that and make it visible if all controls pass, else raise; the version."""
        self._audited(stage(self._scored(rows), path, run_id))
        return publish(path, run_id, self.last_audit.results)
