"""M4 / M5: k-means clustering."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fit_kmeans(df: DataFrame, k: int = 2, max_iter: int = 20, seed: int = 1,
               features: str = "features") -> KMeansModel:
    """Fit k-means (k-means|| initialisation, seeded)."""
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(df)


def kmeans_cost(model: KMeansModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Sum of squared distances of points to their centre, computed on the
    executors (equals the training cost on the training data)."""
    centers = model.clusterCenters()
    spark = df.sparkSession
    cdf = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)],
                                "prediction int, center array<double>")
    from pyspark.ml.functions import vector_to_array
    pred = model.transform(df).select(vector_to_array(features).alias("p"), "prediction")
    j = pred.join(F.broadcast(cdf), "prediction")  # k rows, bounded by k
    sq = F.aggregate(F.zip_with("p", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                     lambda acc, x: acc + x)
    return j.agg(F.sum(sq).alias("cost"))


def kmeans_centers(model: KMeansModel, spark: SparkSession) -> DataFrame:
    """Cluster centres as rows ``(cluster, center)`` (k rows)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    schema = T.StructType([T.StructField("cluster", T.IntegerType()),
                           T.StructField("center", T.ArrayType(T.DoubleType()))])
    return spark.createDataFrame(rows, schema)


def kmeans_points(model: KMeansModel, df: DataFrame, keep: list[str] | None = None,
                  features: str = "features") -> DataFrame:
    """The cluster of every point, with the squared distance to its centre
    and to the nearest one (the k centres are part of the expression)."""
    from pyspark.ml.functions import vector_to_array
    distances = [F.aggregate(F.zip_with("_p", F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)),
                             F.lit(0.0), lambda s, x: s + x) for c in model.clusterCenters()]
    out = model.transform(df).withColumn("_p", vector_to_array(features)).withColumn("_d", F.array(*distances))
    return out.select(*(keep or []), F.col("prediction").alias("cluster"),
                      F.col("_d")[F.col("prediction")].alias("distance"), F.array_min("_d").alias("nearest"))
