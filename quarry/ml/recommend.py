"""M1-M3: ALS collaborative filtering and its error measures."""

from __future__ import annotations

import math

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.sampling import tagged_split
from quarry.session import work_path


def dense_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """(col, out): the distinct non-null values of ``col``, of any orderable
    type, numbered 0, 1, ... in order as integers. Values are sorted in
    ranges and written once, so a value's range, and with it its number,
    holds for good; numbers inside a range start where earlier ranges end."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    path = work_path(spark, f"ids-{out}")
    ids = df.select(col).dropna().distinct()
    ids.repartitionByRange(parts, col).withColumn("_r", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(T.StructType([*ids.schema.fields, T.StructField("_r", T.IntegerType())])).parquet(path)
    earlier = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    base = ranged.groupBy("_r").agg(F.count(F.lit(1)).alias("_n")).select(
        "_r", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    own = Window.partitionBy("_r").orderBy(col)
    return ranged.join(F.broadcast(base), "_r").select(  # at most one row a shuffle partition
        col, (F.col("_base") + F.row_number().over(own) - 1).cast("int").alias(out))


def with_dense_ids(ratings: DataFrame, user: str = "userId", item: str = "movieId") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings with integer ``user_ix`` and ``item_ix`` beside ids of any
    type (ALS takes 32-bit ids only), and the two numberings. Rows with a
    null id are left out, as they can't be trained on."""
    users, items = dense_ids(ratings, user, "user_ix"), dense_ids(ratings, item, "item_ix")
    return ratings.join(users, user).join(items, item), users, items


#: Blocks of a side that ALS is given at least; both sides' together make BLOCKS squared.
LEAST_BLOCKS, BLOCKS = 5, 10


def als_blocks(ratings: DataFrame, user: str, item: str) -> tuple[int, int]:
    """(user blocks, item blocks). In every iteration an item's factors travel
    to nearly all user blocks and a user's to nearly all item blocks, so the
    side with fewer factors gets fewer blocks. BLOCKS each, ALS's default, is
    right for sides of equal size."""
    n, m = ratings.agg(F.approx_count_distinct(user), F.approx_count_distinct(item)).first()
    users = min(max(round(BLOCKS * math.sqrt(max(n, 1) / max(m, 1))), LEAST_BLOCKS), BLOCKS ** 2 // LEAST_BLOCKS)
    return users, BLOCKS ** 2 // users


def fit_als(ratings: DataFrame, user: str = "userId", item: str = "movieId", rating: str = "rating",
            rank: int = 10, max_iter: int = 5, reg: float = 0.01, seed: int = 42,
            cold_start: str = "drop", checkpoint_interval: int = 10):
    """M1 / M3: fit ALS (ids must be integers). ``cold_start="drop"``
    removes predictions for users/items unseen in training, so metrics stay
    defined; ``"nan"`` keeps them. Iteration lineage is cut every
    ``checkpoint_interval`` iterations into the session's checkpoint folder."""
    user_blocks, item_blocks = als_blocks(ratings, user, item)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol=user, itemCol=item,
              ratingCol=rating, coldStartStrategy=cold_start, seed=seed,
              checkpointInterval=checkpoint_interval, numUserBlocks=user_blocks, numItemBlocks=item_blocks)
    return als.fit(ratings)


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> float:
    """M2: root-mean-squared error (Spark's evaluator)."""
    ev = RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol=prediction)
    return ev.evaluate(predictions)


def split_once(ratings: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """The parts of a seeded split (see :func:`quarry.operators.tagged_split`)
    of rows that are dealt and written once, and read by every use."""
    tagged = tagged_split(ratings, weights, seed, "_split")
    path = work_path(ratings.sparkSession, "split")
    tagged.write.partitionBy("_split").parquet(path)
    whole = ratings.sparkSession.read.schema(tagged.schema).parquet(path)
    return [whole.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def als_fit_score(ratings: DataFrame, train_weight: float = 0.8, seed: int = 42,
                  parts: list[DataFrame] | None = None, **als_args):
    """M1 + M2: seeded 0.8 / 0.2 split (or the ``parts`` given), fit on the
    first part, score the held-out part. Returns (model, predictions, metrics
    frame)."""
    train, test = parts or split_once(ratings, [train_weight, 1 - train_weight], seed)
    model = fit_als(train, seed=seed, **als_args)
    pred = model.transform(test)
    label = als_args.get("rating", "rating")
    d = F.col(label) - F.col("prediction")
    metrics = pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).alias("scored"))
    return model, pred, metrics
