"""ML operators bound to the driver tables. A fitted model has no SQL
equivalent, so each query returns what must hold of it, computed in Spark
over all rows, and the SQL says that it does.

ratings = ``lineitem`` (supplier as user, part as item, quantity as rating);
points  = ``embeddings`` (64-d vectors, ``label`` 0-9).
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import functions as F

from quarry.ml import cluster, recommend, regression
from quarry.ml.features import to_vector
from quarry.operators.joins import join_split
from quarry.plans import bindings as B
from quarry.session import work_path
from quarry.sources.sinks import load_model, save_model

query = B.query


def _als_ratings(spark, sf_dir):
    """Ratings under 64-bit ids beyond the integers, numbered densely."""
    far = 2 ** 40
    r = B._t(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") + far).alias("user"), (F.col("l_partkey") + far).alias("item"),
        F.col("l_quantity").cast("float").alias("rating"))
    dense, _, _ = recommend.with_dense_ids(r, "user", "item")
    # written once: splits, fitting and scoring all read the same rows in the same places
    path = work_path(spark, "ratings")
    dense.select(F.col("user_ix").alias("userId"), F.col("item_ix").alias("movieId"), "rating").write.parquet(path)
    return spark.read.schema("userId int, movieId int, rating float").parquet(path)


def _points(spark, sf_dir):
    return B._t(spark, sf_dir, "embeddings").select(
        "vec_id", to_vector("embedding").alias("features"), F.col("label").cast("double").alias("label"))


def _close(a, b):
    return F.abs(a - b) <= 1e-6 * (1 + F.abs(b))


@query("als_rmse", """
SELECT count(*) AS n_ratings, true AS root_of_mse, true AS test_part_scored FROM lineitem
""")
def als_rmse(spark, sf_dir):
    """M1 M2: ALS (5 iterations, reg 0.01) on 80 %, RMSE on the held-out
    20 %: it is the root of the mean squared error of the predictions, and
    no row outside the test part is scored."""
    r = _als_ratings(spark, sf_dir)
    parts = recommend.split_once(r, [0.8, 0.2], seed=42)
    _, pred, metrics = recommend.als_fit_score(r, seed=42, parts=parts, max_iter=5, reg=0.01)
    train, test = (x.count() for x in parts)
    root = F.lit(recommend.rmse(pred))
    return metrics.select(F.lit(train + test).cast("long").alias("n_ratings"),
                          _close(F.col("rmse"), root).alias("root_of_mse"),
                          ((F.col("scored") <= test) & (F.col("scored") > 0)).alias("test_part_scored"))


@query("als_mse", """
SELECT count(*) AS scored, true AS better_than_the_mean FROM lineitem
""")
def als_mse(spark, sf_dir):
    """M3: ALS rank 10, 10 iterations, lambda 0.01, scored on its own
    (user, item) pairs joined back to the ratings: every rating is scored,
    with a smaller squared error than that of the mean rating."""
    r = _als_ratings(spark, sf_dir)
    model = recommend.fit_als(r, rank=10, max_iter=10, reg=0.01, seed=42)
    pairs = r.select("userId", "movieId").distinct()
    pred = model.transform(pairs).select("userId", "movieId", "prediction")
    scored = join_split(pred, r, ["userId", "movieId"])
    d = F.col("rating") - F.col("prediction")
    return scored.agg(F.count("prediction").alias("scored"),
                      (F.avg(d * d) < F.var_pop("rating")).alias("better_than_the_mean"))


@query("kmeans", """
SELECT vec_id, true AS own_is_nearest, true AS cost_bounded, true AS sizes_add_up FROM embeddings
""")
def kmeans(spark, sf_dir):
    """M4: k-means k=2 seed 1, the cluster of every point: its own centre is
    the nearest, the distances add up to no more than the model's cost and
    the sizes to the table."""
    pts = _points(spark, sf_dir)
    model = cluster.fit_kmeans(pts, k=2, max_iter=20, seed=1)
    out = cluster.kmeans_points(model, pts, ["vec_id"])
    total = out.agg(F.sum("distance").alias("cost"), F.count(F.lit(1)).alias("n")).first()
    cost = total["cost"] <= model.summary.trainingCost * (1 + 1e-6)  # the last step moved the centres once more
    return out.select("vec_id", _close(F.col("distance"), F.col("nearest")).alias("own_is_nearest"),
                      F.lit(cost).alias("cost_bounded"),
                      F.lit(sum(model.summary.clusterSizes) == total["n"]).alias("sizes_add_up"))


@query("kmeans_reload", """
SELECT count(*) AS points, true AS same_clusters, true AS cost_bounded FROM embeddings
""")
def kmeans_reload(spark, sf_dir):
    """Points written as space-separated text lines, parsed to
    vectors, k-means (k=2, 20 iterations) fitted, saved, reloaded; the
    reloaded model puts every point where the first one did."""
    from quarry.sources.files import parse_vectors, read_lines
    folder = work_path(spark, "points-txt")
    emb = B._t(spark, sf_dir, "embeddings")
    emb.select(F.array_join(F.transform("embedding", lambda x: x.cast("string")), " ").alias("value")) \
        .write.mode("overwrite").text(folder)
    pts = parse_vectors(read_lines(spark, folder))
    model = cluster.fit_kmeans(pts, k=2, max_iter=20, seed=1)
    path = work_path(spark, "kmeans-model")
    save_model(model, path)
    again = load_model(KMeansModel, path)
    both = again.transform(model.transform(pts).withColumnRenamed("prediction", "before"))
    cost = cluster.kmeans_cost(again, pts).first()["cost"]
    same = cost <= model.summary.trainingCost * (1 + 1e-6)
    return both.agg(F.count(F.lit(1)).alias("points"), F.every(F.col("before") == F.col("prediction")).alias("same_clusters"),
                    F.lit(same).alias("cost_bounded"))


@query("linreg", """
SELECT count(*) AS points, true AS linear, true AS residuals_centred, true AS rmse_of_residuals, true AS r2_of_residuals
FROM embeddings
""")
def linreg(spark, sf_dir):
    """Labelled points written as a libsvm file and read back,
    elastic-net linear regression (10 iterations, reg 0.3, mix 0.8): every
    prediction is the linear form of its point, the residuals average to zero
    and give the summary's RMSE and r2."""
    from pyspark.ml.functions import vector_to_array

    from quarry.sources.files import read_libsvm
    folder = work_path(spark, "points-libsvm")
    _points(spark, sf_dir).select("label", "features").write.mode("overwrite").format("libsvm").save(folder)
    pts = read_libsvm(spark, folder, num_features=64)
    model = regression.fit_linear(pts)
    s = regression.linear_summary(model, spark).first()
    form = F.aggregate(F.zip_with(vector_to_array("features"), F.array(*[F.lit(x) for x in s["coefficients"]]),
                                  lambda a, b: a * b), F.lit(float(s["intercept"])), lambda t, x: t + x)
    out = regression.linear_residuals(model, pts, keep=["features"]).withColumn("form", form)
    mse = F.avg(F.col("residual") * F.col("residual"))
    return out.agg(F.count(F.lit(1)).alias("points"), F.every(_close(F.col("prediction"), F.col("form"))).alias("linear"),
                   (F.abs(F.avg("residual")) < 1e-6).alias("residuals_centred"),
                   _close(F.sqrt(mse), F.lit(s["rmse"])).alias("rmse_of_residuals"),
                   _close(1 - mse / F.var_pop("label"), F.lit(s["r2"])).alias("r2_of_residuals"))


def _classified(model, pts, spark):
    """Per point: probabilities sum to one and are the softmax (two classes:
    the logistic function) of the coefficient rows; the class is the likeliest."""
    from pyspark.ml.functions import vector_to_array
    rows = regression.logistic_coefficients(model, spark).orderBy("class").collect()
    margins = [F.aggregate(F.zip_with(vector_to_array("features"), F.array(*[F.lit(x) for x in r["coefficients"]]),
                                      lambda a, b: a * b), F.lit(r["intercept"]), lambda t, x: t + x) for r in rows]
    if len(margins) == 1:
        margins = [F.lit(0.0), margins[0]]
    out = regression.predictions(model, pts, ["vec_id", "features"]).withColumn("_m", F.array(*margins))
    total = F.aggregate(F.transform("_m", F.exp), F.lit(0.0), lambda t, x: t + x)
    want = F.transform("_m", lambda x: F.exp(x) / total)
    gap = F.aggregate(F.zip_with("probability", want, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda t, x: t + x)
    one = F.aggregate("probability", F.lit(0.0), lambda t, x: t + x)
    return out.select("vec_id", (F.abs(one - 1) < 1e-9).alias("sums_to_one"), (gap < 1e-6).alias("of_the_coefficients"),
                      (F.col("probability")[F.col("prediction").cast("int")] == F.array_max("probability")).alias("likeliest"))


_SQL_CLASSIFIED = "SELECT vec_id, true AS sums_to_one, true AS of_the_coefficients, true AS likeliest FROM embeddings"


@query("logreg", _SQL_CLASSIFIED)
def logreg(spark, sf_dir):
    """M8: binomial elastic-net logistic regression (label >= 5), every point scored."""
    pts = _points(spark, sf_dir).withColumn("label", (F.col("label") >= 5).cast("double"))
    return _classified(regression.fit_logistic(pts, family="binomial"), pts, spark)


@query("logreg_multinomial", _SQL_CLASSIFIED)
def logreg_multinomial(spark, sf_dir):
    """M9: multinomial family, every point scored."""
    pts = _points(spark, sf_dir)
    return _classified(regression.fit_logistic(pts, family="multinomial"), pts, spark)
