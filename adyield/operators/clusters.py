"""Clusters of attribute buckets by average figures or by the similarity of their daily curves."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from adyield.functions.numeric import wavg, wstd
from adyield.operators.tree import TreeClusters, fit_tree
from adyield.session import checkpointed

KPIS = ("rps", "score", "lps", "rpl")
SMOOTH_DAYS = 7


def bucket_means(rows: DataFrame, bucket: Sequence[str], kpis: Sequence[str] = KPIS) -> DataFrame:
    """Sessions, revenue and session-weighted figures per bucket."""
    return rows.groupBy(*bucket).agg(
        F.sum("sessions").alias("sessions"), F.sum("revenue").alias("revenue"),
        *[F.coalesce(wavg(F.col(k), F.col("sessions")), F.lit(0.0)).alias(k) for k in kpis])


def _numbered(buckets: DataFrame, bucket: Sequence[str]) -> DataFrame:
    return buckets.withColumn("clust", F.row_number().over(Window.orderBy(*bucket)) - 1)


def _kmeans(vectors: DataFrame, bucket: Sequence[str], clusters: int, seed: int) -> DataFrame:
    """Cluster per bucket; no more buckets than clusters means one cluster each."""
    vectors = checkpointed(vectors)
    if len(vectors.take(clusters + 1)) <= clusters:
        return _numbered(vectors, bucket).select(*bucket, "clust")
    model = KMeans(k=clusters, seed=seed, weightCol="sessions", predictionCol="clust").fit(vectors)
    return model.transform(vectors).select(*bucket, "clust")


def mean_clusters(rows: DataFrame, bucket: Sequence[str], clusters: int = 8, kpis: Sequence[str] = KPIS,
                  seed: int = 1) -> DataFrame:
    """K-means on the buckets' session-weighted figures."""
    assembled = VectorAssembler(inputCols=list(kpis), outputCol="features").transform(bucket_means(rows, bucket, kpis))
    return _kmeans(assembled.withColumn("sessions", F.col("sessions").cast("double")), bucket, clusters, seed)


def daily_curves(rows: DataFrame, bucket: Sequence[str], kpis: Sequence[str] = KPIS) -> DataFrame:
    """Per bucket one array per figure: its 7-day mean on the gap-free day axis, zero where missing.

    The arrays are as long as the date range, whatever the number of rows behind a bucket.
    """
    daily = rows.groupBy(*bucket, "utc_dt").agg(
        F.sum("sessions").alias("sessions"), *[wavg(F.col(k), F.col("sessions")).alias(k) for k in kpis])
    span = rows.agg(F.struct(F.min("utc_dt").alias("first"), F.max("utc_dt").alias("last"))).scalar()
    axis = daily.select(*bucket).distinct().withColumn("span", span).select(
        *bucket, F.explode(F.sequence("span.first", "span.last")).alias("utc_dt"))
    filled = axis.join(daily, [*bucket, "utc_dt"], "left").na.fill(0.0, subset=["sessions", *kpis])
    recent = Window.partitionBy(*bucket).orderBy("utc_dt").rowsBetween(-(SMOOTH_DAYS - 1), 0)
    smooth = filled.select(*bucket, "utc_dt", "sessions", *[
        F.when(F.count("*").over(recent) == SMOOTH_DAYS, F.avg(k).over(recent)).otherwise(F.lit(0.0)).alias(k)
        for k in kpis])
    gathered = smooth.groupBy(*bucket).agg(
        F.sum("sessions").cast("double").alias("sessions"),
        F.array_sort(F.collect_list(F.struct("utc_dt", *kpis))).alias("days"))
    return gathered.select(*bucket, "sessions", *[F.col(f"days.{k}").alias(k) for k in kpis])


def _norm(array, scale: float = 1.0):
    return F.aggregate(array, F.lit(0.0), lambda total, v: total + v * v * F.lit(scale))


def _times(array, factor: float):
    return F.transform(array, lambda v: v * F.lit(factor))


def _gram_root(vectors: DataFrame) -> np.ndarray:
    """Symmetric square root of the curves' Gram matrix (days x days, summed on the executors)."""
    dense = MLUtils.convertVectorColumnsFromML(vectors.select(array_to_vector("v").alias("v")), "v")
    matrix = RowMatrix(dense).computeGramianMatrix().toArray()
    values, basis = np.linalg.eigh(matrix)
    return (basis * np.sqrt(np.clip(values, 0.0, None))) @ basis.T


def _project(vectors: DataFrame, root: np.ndarray) -> DataFrame:
    def multiply(batch: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(batch.to_numpy()) @ root))

    return vectors.withColumn("v", F.pandas_udf(multiply, ArrayType(DoubleType()))("v"))


def similarity_vectors(rows: DataFrame, bucket: Sequence[str], kpis: Sequence[str] = KPIS, similarity: str = "cokpi",
                       method: str = "mean") -> DataFrame:
    """Vectors whose distances equal those between rows of the buckets' similarity matrix.

    Similarities are inner products a_i . a_j of curve vectors, so row i of the n x n matrix is A a_i
    and |A a_i - A a_j| = |R (a_i - a_j)| with R the square root of A'A. R is only days x days: no pair
    of buckets is ever formed.
    """
    curves = checkpointed(daily_curves(rows, bucket, kpis))
    if similarity == "cokpi":
        roots = curves.select(*bucket, "sessions", *[F.transform(k, lambda v: F.sqrt(F.greatest(v, F.lit(0.0)))).alias(k) for k in kpis])
        # the largest inner product of a figure is the largest squared length
        tops = roots.agg(*[F.max(_norm(F.col(k))).alias(k) for k in kpis]).first()
        scale = {k: (1.0 / tops[k]) ** 0.5 if tops[k] else 0.0 for k in kpis}
        scaled = roots.select(*bucket, "sessions", *[_times(k, scale[k]).alias(k) for k in kpis])
    elif similarity == "correlation":
        size = F.size(kpis[0])
        stats = curves.select("*", *[c for k in kpis for c in (
            (F.aggregate(k, F.lit(0.0), lambda t, v: t + v) / size).alias(f"{k}_mean"),
            (_norm(F.col(k)) / size).alias(f"{k}_square"))])

        def standard(k: str):
            deviation = F.sqrt(F.greatest(F.col(f"{k}_square") - F.col(f"{k}_mean") * F.col(f"{k}_mean"), F.lit(0.0)))
            flat = deviation < 1e-12
            return F.transform(k, lambda v: F.when(flat, F.lit(0.0)).otherwise(
                (v - F.col(f"{k}_mean")) / deviation / F.sqrt(size))).alias(k)

        scaled = stats.select(*bucket, "sessions", *[standard(k) for k in kpis])
    else:
        raise ValueError(f"unknown similarity {similarity}")
    if method == "mean":
        share = (1.0 / len(kpis)) ** 0.5
        joined = scaled.select(*bucket, "sessions", _times(F.concat(*kpis), share).alias("v"))
        out = _project(joined, _gram_root(joined))
    elif method == "stack":
        out = None
        for k in kpis:
            one = scaled.select(*bucket, "sessions", F.col(k).alias("v"))
            part = _project(one, _gram_root(one)).withColumnRenamed("v", f"v_{k}")
            out = part if out is None else out.join(part.drop("sessions"), list(bucket))
        out = out.select(*bucket, "sessions", F.concat(*[f"v_{k}" for k in kpis]).alias("v"))
    else:
        raise ValueError(f"unknown method {method}")
    return out.select(*bucket, "sessions", array_to_vector("v").alias("features"))


def curve_clusters(rows: DataFrame, bucket: Sequence[str], clusters: int = 8, kpis: Sequence[str] = KPIS,
                   similarity: str = "cokpi", method: str = "mean", seed: int = 1) -> DataFrame:
    """K-means on the buckets' curve similarities."""
    return _kmeans(similarity_vectors(rows, bucket, kpis, similarity, method), bucket, clusters, seed)


def similarity_table(rows: DataFrame, bucket: Sequence[str], **options) -> DataFrame:
    """The similarity vectors as plain arrays."""
    return similarity_vectors(rows, bucket, **options).select(*bucket, "sessions", vector_to_array("features").alias("v"))


def hybrid_clusters(rows: DataFrame, attributes: Sequence[str], clusters: int = 8, min_sessions: float = 100,
                    kpis: Sequence[str] = KPIS) -> tuple[TreeClusters, DataFrame]:
    """Curve clusters per attribute, then a tree on the cluster labels; returns the tree and clustered rows."""
    daily = checkpointed(rows)
    labelled = daily
    for a in attributes:
        labels = curve_clusters(daily, [a], clusters, kpis).select(a, F.col("clust").alias(f"{a}_clust"))
        labelled = labelled.join(labels, a, "left")
    names = [f"{a}_clust" for a in attributes]
    tree = fit_tree(labelled, names, clusters, min_sessions=min_sessions)
    return tree, tree.transform(labelled).drop(*names)


# --- reports -----------------------------------------------------------------------------

def cluster_report(rows: DataFrame) -> DataFrame:
    """Sums and weighted figures per cluster."""
    return rows.groupBy("clust").agg(
        F.sum("revenue").alias("revenue"), F.sum("sessions").alias("sessions"), F.sum("leads").alias("leads"),
        wavg(F.col("rps"), F.col("sessions")).alias("rps"), wavg(F.col("lps"), F.col("sessions")).alias("lps"),
        wavg(F.coalesce(F.col("rpl"), F.lit(0.0)), F.col("leads")).alias("rpl"),
    ).withColumns({"rps_check": F.try_divide("revenue", "sessions"), "rpl_check": F.try_divide("revenue", "leads")})


def split_factor(rows: DataFrame, attributes: Sequence[str]) -> int:
    """Distinct (attributes without the one with most values, cluster) combinations."""
    return rows.select(*attribute_order(rows, attributes)[:-1], "clust").distinct().count()


def attribute_order(rows: DataFrame, attributes: Sequence[str]) -> list[str]:
    """Attributes from fewest to most distinct values."""
    counts = rows.agg(*[F.countDistinct(a).alias(a) for a in attributes]).first()
    return sorted(attributes, key=lambda a: (counts[a], a))


def holdout_rows(rows: DataFrame, evaluation_date) -> tuple[DataFrame, DataFrame]:
    """Rows before the evaluation date and from it on."""
    day = F.lit(str(evaluation_date)).cast("date")
    return rows.filter(F.col("utc_dt") < day), rows.filter(F.col("utc_dt") >= day)


def holdout_report(clustered: DataFrame, bucket: Sequence[str], evaluation_date) -> DataFrame:
    """Error of the clusters' daily figure and spread between buckets and clusters, as one row."""
    day_rps = clustered.groupBy("clust", "utc_dt").agg(wavg(F.col("rps"), F.col("sessions")).alias("rps_clust"))
    errors = clustered.join(day_rps, ["clust", "utc_dt"]).agg(
        wavg(F.abs(F.col("rps") - F.col("rps_clust")), F.col("sessions")).alias("rps_mae"))
    _, later = holdout_rows(clustered, evaluation_date)

    def spread(keys: Sequence[str]) -> DataFrame:
        by = later.groupBy(*keys).agg(F.sum("sessions").alias("sessions"), wavg(F.col("rps"), F.col("sessions")).alias("rps"))
        return by.agg(F.struct(F.count("*").alias("n"), wstd(F.col("rps"), F.col("sessions")).alias("spread")))

    return errors.withColumns({"b": spread(bucket).scalar(), "c": spread(["clust"]).scalar()}).select(
        "rps_mae", F.col("b.n").alias("buckets"), F.col("b.spread").alias("split_variance"),
        F.col("c.n").alias("clusters"), F.col("c.spread").alias("cluster_variance"))
