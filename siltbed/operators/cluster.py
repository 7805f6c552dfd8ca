"""Clustering embeddings: optional PCA, choice of k by silhouette, k-means, labels.

Distances are Euclidean in k-means; the silhouette that chooses k uses squared
Euclidean distances, which needs one pass over the rows and no pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import writers
from ..sources.scratch import cut, discard
from . import filters

SEED = 42


def features(df: DataFrame, vector_col: str = "embedding", pca_dim: int = 50) -> DataFrame:
    """Adds ``features``; vectors of another length than most are dropped, and PCA of 0 or less is skipped."""
    dim = df.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dim is None:
        return df.limit(0).withColumn("features", array_to_vector(F.array().cast("array<double>")))
    rows = df.where(F.size(vector_col) == dim["d"]).withColumn("features", array_to_vector(F.col(vector_col).cast("array<double>")))
    if not 0 < pca_dim < dim["d"]:
        return rows
    fitted = PCA(k=pca_dim, inputCol="features", outputCol="_pca").fit(rows)
    return fitted.transform(rows).drop("features").withColumnRenamed("_pca", "features")


def stored_features(df: DataFrame, vector_col: str = "embedding", pca_dim: int = 50) -> DataFrame:
    """``features``, written once, so that each fit reads them and does not project again."""
    return cut(features(df, vector_col, pca_dim), "features")


def evaluate(labelled: DataFrame) -> float:
    """The mean silhouette of ``prediction`` by squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(labelled)


def silhouette(sample: DataFrame, k: int, seed: int = SEED) -> float:
    labelled = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="prediction").fit(sample).transform(sample)
    if labelled.select("prediction").distinct().count() < 2:
        return float("-inf")
    return evaluate(labelled)


def best_k(sample: DataFrame, low: int = 2, high: int = 15, scorer: Callable[[DataFrame, int], float] = silhouette) -> int:
    """The k of the best score, the smallest of equals; a rule of thumb if none is possible."""
    n = sample.count()
    if n < 2:
        return 1
    best, found = float("-inf"), None
    for k in range(max(2, low), min(high, n - 1) + 1):
        got = scorer(sample, k)
        if got > best:
            best, found = got, k
    return found or max(2, min(8, int(n**0.5)))


def fit(df: DataFrame, k: int, seed: int = SEED, max_iter: int = 20, tol: float = 1e-4) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="kmeans_label", maxIter=max_iter, tol=tol).fit(df)


def label(df: DataFrame, model: KMeansModel) -> DataFrame:
    """``kmeans_label`` as the last column, replacing one that is there."""
    out = model.transform(df.drop("kmeans_label"))
    return out.withColumn("kmeans_label", F.col("kmeans_label").cast("long")).drop("features")


def summary(labelled: DataFrame, k: int) -> dict:
    n, dim = labelled.agg(F.count("*"), F.max(F.size("embedding"))).first()
    return {"best_k": k, "n_samples": n, "dim": dim}


def run(
    df: DataFrame, path: str, file: str, key: Column, low: int = 2, high: int = 15, pca_dim: int = 50, sample: int = 20_000, vector_col: str = "embedding", seed: int = SEED
) -> dict:
    """The whole job: features, k by the silhouette of a sample per file, fit on all rows, labels by file, summary.

    Writes ``labels`` (partitioned by nothing, the file as a column, rows counted)
    and ``result.json`` under ``path``.  Rows without a readable vector get no label.
    """
    rows = stored_features(df, vector_col, pca_dim)
    some = cut(filters.per_file_sample(rows, file, sample, key), "sample")
    scores: dict[int, float] = {}

    def scored(part: DataFrame, k: int) -> float:
        scores[k] = silhouette(part, k, seed)
        return scores[k]

    k = best_k(some, low, high, scored)
    labelled = label(rows, fit(rows, k, seed))
    writers.write_labels(labelled, rows, f"{path}/labels")
    result = summary(labelled, k) | {"scores": scores}
    writers.write_manifest(df.sparkSession, result, f"{path}/result.json")
    discard(rows, some)
    return result
