"""Training, scoring and explaining the churn classifier."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.churn_features import ENCODED, FOLDS, category_lists, one_hot, stratified_split
from ..plans.durable import ensure_checkpoint_dir, settle
from .evaluation import confusion_counts, metric_table, ranking_scores, report_rows

LABEL = "churned"
KEY = "customer_id"
# recency_days also defines the label; with it among the inputs every model separates the classes.
LEAKING = ("recency_days",)
SEED = 42
# Rows worth a task of their own, and the most rows of a task.
TASK_ROWS, MOST_ROWS = 20_000, 1_000_000


def _estimator(kind: str, training_rows: int):
    common = {"featuresCol": "scaled", "labelCol": LABEL}
    # Hyper-parameters of the three model kinds.
    if kind == "gbm":
        return GBTClassifier(maxIter=200, stepSize=0.05, maxDepth=4, seed=SEED, **common)
    if kind == "rf":
        # The node that each tree has put a row in is kept, not searched from the root at each level: the same forest.
        return RandomForestClassifier(numTrees=200, maxDepth=6, seed=SEED, cacheNodeIds=True, **common)
    if kind == "lr":
        # An inverse penalty of 0.1 on the summed loss, restated for MLlib's averaged loss.
        return LogisticRegression(maxIter=1000, regParam=1 / (0.1 * training_rows), elasticNetParam=0.0, **common)
    raise ValueError(f"unknown model {kind!r}; choose gbm, rf or lr")


def numeric_columns(features: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skipped = {LABEL, KEY, "is_test", "fold", *exclude}
    return [
        f.name
        for f in features.schema.fields
        if f.name not in skipped and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def _model_input(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Features as doubles, unknown values as 0."""
    return features.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def _dealt(split: DataFrame) -> DataFrame:
    """A settled table, spread evenly: fits go through it hundreds of times, each time as long as its longest task.

    A level of a tree is a short job, so there are no more tasks than cores unless they would be very long.
    Small tables stay as they are.
    """
    rows, cores = split.count(), split.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, rows // TASK_ROWS), -(-rows // MOST_ROWS))
    return settle(split.repartition(tasks, KEY).sortWithinPartitions(KEY)) if tasks > 1 else split


def _fits_at_once(kind: str, spread: bool) -> int:
    """Fits of a few short jobs fill each other's gaps. A forest has long jobs and numbers per row and tree, so on a
    large table one is held in memory at a time."""
    return 1 if spread and kind == "rf" else FOLDS + 1


@dataclass(frozen=True)
class ChurnModel:
    """A fitted pipeline and what it takes to prepare other tables as the training table was."""

    kind: str
    columns: tuple[str, ...]
    pipeline: PipelineModel
    lists: dict[str, list[str]]
    test: DataFrame | None = None
    cv_areas: tuple[float, float] | None = None

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.active()
        facts = [(self.kind, list(self.columns), json.dumps(self.lists))]
        spark.createDataFrame(facts, "kind string, columns array<string>, lists string").coalesce(1).write.mode("overwrite").json(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ChurnModel:
        facts = spark.read.schema("kind string, columns array<string>, lists string").json(f"{path}/facts").first()
        return ChurnModel(facts["kind"], tuple(facts["columns"]), PipelineModel.load(f"{path}/pipeline"), json.loads(facts["lists"]))

    def prepared(self, features: DataFrame) -> DataFrame:
        """Categories as in training, unknown ones all zeros; inputs that the table lacks are 0."""
        encoded = one_hot(features, {c: v for c, v in self.lists.items() if c in features.columns})
        return _model_input(encoded.withColumns({c: F.lit(0.0) for c in self.columns if c not in encoded.columns}), self.columns)

    def score(self, features: DataFrame) -> DataFrame:
        """Adds prediction and churn_probability."""
        scored = self.pipeline.transform(self.prepared(features))
        probability = vector_to_array("probability")[1]
        return scored.withColumn("churn_probability", probability).drop("assembled", "scaled", "rawPrediction", "probability")

    def probabilities(self, features: DataFrame) -> DataFrame:
        return self.score(features).select(KEY, "churn_probability")

    def metrics(self) -> DataFrame:
        """metric, value on the held-out rows, with the cross-validated area if it was computed."""
        if self.test is None:
            raise ValueError("a loaded model has no held-out rows")
        scored = settle(self.score(self.test).select(LABEL, "prediction", "churn_probability"))
        area, precision = ranking_scores(scored, LABEL, "churn_probability")
        rows = [("roc_auc", area, 4), ("avg_precision", precision, 4)]
        if self.cv_areas is not None:
            rows += [("cv_auc_mean", self.cv_areas[0], 4), ("cv_auc_std", self.cv_areas[1], 4)]
        rows += [(name, value, 6) for name, value in report_rows(confusion_counts(scored, LABEL, "prediction"))]
        return metric_table(self.test, rows)

    def importance(self) -> DataFrame:
        """feature, importance, highest first; tree models only."""
        classifier = self.pipeline.stages[-1]
        if not hasattr(classifier, "featureImportances"):
            raise ValueError(f"model {self.kind!r} has no feature importances")
        weights = classifier.featureImportances.toArray()
        rows = [(name, float(weight)) for name, weight in zip(self.columns, weights)]
        made = SparkSession.active().createDataFrame(rows, "feature string, importance double")
        return made.orderBy(F.desc("importance"), "feature")


def train(
    features: DataFrame, kind: str = "gbm", cross_validate: bool = True, exclude: Sequence[str] = LEAKING
) -> ChurnModel:
    """Fits on the training rows of a stratified split. `exclude=()` keeps the leaking input.

    Text columns of customer_features become 0/1 columns; their values are kept with the model.
    The cross-validation folds and the final fit do not depend on each other, so their jobs are
    submitted side by side and share the cluster (forests on large tables: one after another).
    """
    ensure_checkpoint_dir(features.sparkSession)
    texts = [c for c in ENCODED if c in features.columns]
    if texts:
        features = settle(features)
    lists = category_lists(features, texts)
    features = one_hot(features, lists)
    columns = numeric_columns(features, exclude)
    plain = settle(_model_input(stratified_split(features), columns))
    split = _dealt(plain)
    training, test = split.filter(~F.col("is_test")).persist(), split.filter("is_test")
    assembler = VectorAssembler(inputCols=columns, outputCol="assembled")
    scaler = StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True)
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="probability", numBins=0)

    def fit(rows: DataFrame) -> PipelineModel:
        return Pipeline(stages=[assembler, scaler, _estimator(kind, rows.count())]).fit(rows)

    def area_of(fold: int) -> float:
        held_out = F.col("fold") == fold
        return evaluator.evaluate(fit(training.filter(~held_out)).transform(training.filter(held_out)))

    carry = inheritable_thread_target(features.sparkSession)
    try:
        with ThreadPool(_fits_at_once(kind, split is not plain)) as pool:
            final = pool.apply_async(carry(fit), [training])
            areas = pool.map(carry(area_of), range(FOLDS), chunksize=1) if cross_validate else []
            pipeline = final.get()
    finally:
        training.unpersist()
    spread = (float(np.mean(areas)), float(np.std(areas))) if areas else None
    return ChurnModel(kind, tuple(columns), pipeline, lists, test, spread)
