"""Spark ML jobs (M1-M9): ALS recommendations, k-means, elastic-net linear
and logistic regression. All fitting runs on the cluster; only model
parameters (bounded by rank / k / feature count) reach the driver."""

from quarry.ml.cluster import fit_kmeans, kmeans_centers, kmeans_cost, kmeans_points  # noqa: F401
from quarry.ml.recommend import als_fit_score, dense_ids, fit_als, rmse, with_dense_ids  # noqa: F401
from quarry.ml.regression import (  # noqa: F401
    fit_linear, fit_logistic, linear_residuals, linear_summary, logistic_coefficients, predictions,
)
from quarry.ml.features import to_vector  # noqa: F401
