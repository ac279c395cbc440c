"""K-Means customer clusters on standardised RFM features."""

from __future__ import annotations

from collections.abc import Iterable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.segmentation import standardised
from ..plans.durable import settle
from . import many_means

# Features, seed, restarts and iterations of a fit.
AXES = ("recency", "frequency", "monetary")
SEED = 42
RESTARTS = 10
ITERATIONS = 300
# Fits that may run at the same time; each is itself a distributed job.
CONCURRENT_FITS = RESTARTS


def scaled_vectors(rfm: DataFrame) -> DataFrame:
    """Adds `scaled`: the three features at mean 0 and population standard deviation 1."""
    columns = [f"{axis}_z" for axis in AXES]
    return VectorAssembler(inputCols=columns, outputCol="scaled").transform(standardised(rfm, AXES)).drop(*columns)


def _best_model(vectors: DataFrame, k: int, restarts: int) -> KMeansModel:
    """The restart with the lowest inertia; fits do not depend on each other and overlap."""

    def fit(seed: int) -> KMeansModel:
        means = KMeans(k=k, seed=seed, maxIter=ITERATIONS, featuresCol="scaled", predictionCol="cluster")
        return means.fit(vectors)

    with ThreadPool(CONCURRENT_FITS) as pool:
        models = pool.map(inheritable_thread_target(vectors.sparkSession)(fit), [SEED + n for n in range(restarts)])
    return min(models, key=lambda model: model.summary.trainingCost)


def fit_clusters(rfm: DataFrame, k: int = 5, restarts: int = RESTARTS) -> tuple[KMeansModel, DataFrame, float]:
    """The model with the lowest inertia, the table with `cluster` added, and the silhouette.

    The silhouette uses squared distances, which needs one pass instead of all pairs.
    """
    vectors = scaled_vectors(settle(rfm)).persist()
    try:
        model = _best_model(vectors, k, restarts)
        labelled = settle(model.transform(vectors))
    finally:
        vectors.unpersist()
    return model, labelled.drop("scaled"), silhouette(labelled)


def silhouette(labelled: DataFrame) -> float:
    return ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster").evaluate(labelled)


def optimal_k(rfm: DataFrame, ks: Iterable[int] = range(2, 11), restarts: int = RESTARTS) -> DataFrame:
    """k, inertia, silhouette: one row per number of clusters tried; the silhouette of fewer than two clusters is null.

    All numbers of clusters and restarts share each pass over the customers.
    """
    columns = [f"{axis}_z" for axis in AXES]
    scaled = standardised(settle(rfm), AXES).select(*[F.col(c).cast("double") for c in columns], F.xxhash64("customer_id").alias("noise"))
    # A pass is arithmetic, so the rows, however few, are dealt to all cores.
    rows = settle(scaled.repartition(rfm.sparkSession.sparkContext.defaultParallelism)).persist()
    try:
        models = many_means.fit(rows, columns, ks, [SEED + n for n in range(restarts)], ITERATIONS)
    finally:
        rows.unpersist()
    found = [(m.k, m.inertia, m.silhouette) for m in models]
    return rfm.sparkSession.createDataFrame(found, "k int, inertia double, silhouette double")


def cluster_labels(rfm: DataFrame, k: int = 5, restarts: int = RESTARTS) -> DataFrame:
    _, labelled, _ = fit_clusters(rfm, k, restarts)
    return labelled.select("customer_id", F.col("cluster").cast("int"))
