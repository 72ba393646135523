import math

from pyspark.sql import functions as F

from quarry.ml import cluster, recommend, regression
from quarry.ml.features import to_vector


def _points(spark):
    pts = [(0.0, 0.0, 0.0), (0.1, 0.1, 0.1), (0.2, 0.2, 0.2), (9.0, 9.0, 9.0), (9.1, 9.1, 9.1), (9.2, 9.2, 9.2)]
    return spark.createDataFrame([(list(p),) for p in pts], "a array<double>").select(to_vector("a").alias("features"))


def test_kmeans_cost_matches_recomputed(spark):
    pts = _points(spark)
    m = cluster.fit_kmeans(pts, k=2, seed=1)
    cost = cluster.kmeans_cost(m, pts).first().cost
    assert math.isclose(cost, m.summary.trainingCost, rel_tol=1e-9, abs_tol=1e-12)
    centers = sorted(r.center[0] for r in cluster.kmeans_centers(m, spark).collect())
    assert math.isclose(centers[0], 0.1, abs_tol=1e-9) and math.isclose(centers[1], 9.1, abs_tol=1e-9)
    q = spark.createDataFrame([([0.0, 0.0, 0.0],), ([10.0, 10.0, 10.0],)], "a array<double>").select(
        to_vector("a").alias("features"))
    assert len({r.prediction for r in m.transform(q).collect()}) == 2


def test_als_rmse_is_sqrt_of_mse(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(20) for i in range(15)]
    r = spark.createDataFrame(rows, "userId int, movieId int, rating float")
    model, pred, metrics = recommend.als_fit_score(r, 0.8, seed=3, max_iter=5, reg=0.01)
    m = metrics.first()
    d = F.col("rating") - F.col("prediction")
    mse = pred.agg(F.avg(d * d)).first()[0]
    assert math.isclose(m.rmse, math.sqrt(mse), rel_tol=1e-9)
    assert math.isclose(m.rmse, recommend.rmse(pred), rel_tol=1e-6)
    assert pred.filter(F.isnan("prediction")).count() == 0


def test_als_side_with_fewer_factors_gets_fewer_blocks(spark, monkeypatch):
    few_users = spark.createDataFrame([(u, i, float(u + i)) for u in range(4) for i in range(80)],
                                      "userId int, movieId int, rating float")
    flipped = few_users.selectExpr("movieId AS userId", "userId AS movieId", "rating")
    given, whole = [], recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **args: given.append(args) or whole(**args))
    for r in (few_users, flipped):
        m = recommend.fit_als(r, max_iter=2)
        assert (m.userFactors.count(), m.itemFactors.count()) in ((4, 80), (80, 4))
    assert [(g["numUserBlocks"], g["numItemBlocks"]) for g in given] == [(5, 20), (20, 5)]
    assert recommend.als_blocks(few_users.filter("movieId < 4"), "userId", "movieId") == (10, 10)
    assert recommend.als_blocks(few_users.limit(0), "userId", "movieId") == (10, 10)


def test_regressions(spark):
    rows = [(float(x % 2), [float(x), float(x % 3), 1.0]) for x in range(40)]
    df = spark.createDataFrame(rows, "label double, a array<double>").select("label", to_vector("a").alias("features"))
    lin_rows = [(2.0 * x + 3.0 * (x % 3), [float(x), float(x % 3), 1.0]) for x in range(40)]
    lin_df = spark.createDataFrame(lin_rows, "label double, a array<double>").select(
        "label", to_vector("a").alias("features"))
    lin = regression.fit_linear(lin_df)
    s = regression.linear_summary(lin, spark).first()
    assert s.iterations >= 1 and len(s.coefficients) == 3 and s.r2 > 0.9
    assert len(s.objective_history) == s.iterations + 1
    log = regression.fit_logistic(df, family="binomial")
    assert regression.logistic_coefficients(log, spark).count() == 1
    multi = regression.fit_logistic(df.withColumn("label", F.col("label") + 1), family="multinomial")
    assert regression.logistic_coefficients(multi, spark).count() == 3
