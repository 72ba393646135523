"""M6-M9: elastic-net linear and logistic regression."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def fit_linear(df: DataFrame, max_iter: int = 10, reg: float = 0.3, mix: float = 0.8,
               label: str = "label", features: str = "features"):
    """M6."""
    return LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=mix,
                            labelCol=label, featuresCol=features).fit(df)


def linear_summary(model, spark: SparkSession) -> DataFrame:
    """M7: one row with coefficients, intercept, iterations, objective
    history, RMSE and r2 of the training summary (residuals, one per row, are
    :func:`linear_residuals`)."""
    s = model.summary
    row = ([float(x) for x in model.coefficients], float(model.intercept), int(s.totalIterations),
           [float(x) for x in s.objectiveHistory], float(s.rootMeanSquaredError), float(s.r2))
    schema = T.StructType([
        T.StructField("coefficients", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("iterations", T.IntegerType()),
        T.StructField("objective_history", T.ArrayType(T.DoubleType())),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("r2", T.DoubleType())])
    return spark.createDataFrame([row], schema)


def predictions(model, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Scores of every row under a fitted linear or logistic model:
    ``prediction`` and, for a classifier, ``probability`` as an array."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    cols = [*(keep if keep is not None else df.columns), "prediction"]
    if "probability" in out.columns:
        return out.select(*cols, vector_to_array("probability").alias("probability"))
    return out.select(*cols)


def linear_residuals(model, df: DataFrame, label: str = "label", keep: list[str] | None = None) -> DataFrame:
    """M7: label minus prediction for every row."""
    out = model.transform(df)
    return out.select(*(keep or []), label, "prediction", (out[label] - out["prediction"]).alias("residual"))


def fit_logistic(df: DataFrame, max_iter: int = 10, reg: float = 0.3, mix: float = 0.8,
                 family: str = "auto", label: str = "label", features: str = "features"):
    """M8 / M9: binomial or multinomial (``family``) logistic regression."""
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=mix, family=family,
                              labelCol=label, featuresCol=features).fit(df)


def logistic_coefficients(model, spark: SparkSession) -> DataFrame:
    """Coefficient matrix and intercept vector as rows ``(class, intercept,
    coefficients)``: one row for binomial, one per class for multinomial."""
    m = model.coefficientMatrix.toArray()
    b = model.interceptVector.toArray()
    rows = [(i, float(b[i]), [float(x) for x in m[i]]) for i in range(m.shape[0])]
    schema = T.StructType([T.StructField("class", T.IntegerType()),
                           T.StructField("intercept", T.DoubleType()),
                           T.StructField("coefficients", T.ArrayType(T.DoubleType()))])
    return spark.createDataFrame(rows, schema)
