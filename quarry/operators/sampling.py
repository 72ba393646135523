"""Sampling, splits and reuse."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.chunks import split_by
from quarry.operators.hot import frequent_keys
from quarry.session import work_path


#: Copies of one row that a single task numbers.
COPIES = 100_000
#: Rows of a hash bucket that draws are dealt to, as long as there are at most
#: so many buckets; how many of them form a group.
BUCKET_ROWS, MOST_BUCKETS, GROUP = 64, 2 ** 20, 2 ** 10
#: Places of a bucket that are looked up together.
SEGMENT = 2 ** 16


def _uniform(seed: int, *of) -> Column:
    """A number in [0, 1) that depends on the seed and the values alone."""
    h = F.xxhash64(F.lit(seed).cast("long"), *of)
    return F.shiftrightunsigned(h, 11) / F.lit(float(2 ** 53))


def numbered_copies(df: DataFrame, name: str = "_copy") -> DataFrame:
    """Every row with its number among the rows equal to it, from 0 on.
    (Columns must be of types that can be grouped by.) The copies of a row
    that very many equal are numbered in several tasks."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _, _, hot = frequent_keys(df, df.columns, lambda rows: max(COPIES, -(-rows // (2 * parts))))

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))

    def listed(first: Column, last: Column) -> list[Column]:
        return [*cols, F.explode(F.sequence(first, last)).alias(name)]

    if hot is None:
        return counted(df).select(*listed(F.lit(0).cast("long"), F.col("_n") - 1))
    few, many = split_by(df, hot.drop("_n"), df.columns)
    block, size = F.col("_block"), F.lit(COPIES).cast("long")
    blocks = counted(many).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {COPIES}"))))
    return counted(few).select(*listed(F.lit(0).cast("long"), F.col("_n") - 1)).unionByName(
        blocks.repartition(parts, "_block").select(*listed(block * size, F.least(F.col("_n"), (block + 1) * size) - 1)))


def _dealt(df: DataFrame, seed: int) -> DataFrame:
    rows = numbered_copies(df)
    return rows.withColumn("_u", _uniform(seed, "_copy", *[F.col(f"`{c}`") for c in df.columns])).drop("_copy")


def sample_fraction(df: DataFrame, fraction: float, seed: int, with_replacement: bool = False) -> DataFrame:
    """Bernoulli (or Poisson, with replacement) sample, seeded.

    Without replacement a row's fate hangs on its content, its number among
    equal rows and the seed, so the same rows are taken however the table is
    partitioned. With replacement it is Spark's own sampling, which depends
    on the partitions."""
    if with_replacement:
        return df.sample(True, fraction, seed)
    return _dealt(df, seed).filter(F.col("_u") < fraction).drop("_u")


def sample_n_with_replacement(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement (``takeSample(true, n)``);
    none from an empty frame. ``n`` may be of any size, and the same rows come
    out however the table is partitioned.

    Rows fall in hash buckets. The draws are split over groups of buckets by
    one multinomial draw; a draw then picks a place in its group, which names
    a bucket and a place there, and only the buckets drawn from are read
    again. Equal rows are counted, not carried, so a row that is a third of
    the table is one entry. (Columns must be of types that can be grouped by.)
    """
    spark = df.sparkSession
    cols = df.columns
    buckets = min(-(-df.count() // BUCKET_ROWS), MOST_BUCKETS)
    if buckets == 0 or n <= 0:
        return df.limit(0)
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(buckets)).cast("int")
    path = work_path(spark, "sample-buckets")
    df.select(bucket.alias("_b")).groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).write.parquet(path)
    sizes = spark.read.schema("_b int, _n long").parquet(path).withColumn("_g", F.expr(f"_b div {GROUP}").cast("int"))
    groups = sizes.groupBy("_g").agg(F.sum("_n").alias("_n")).orderBy("_g").collect()  # MOST_BUCKETS / GROUP at most
    total = sum(g["_n"] for g in groups)
    share = np.random.default_rng(seed).multinomial(n, [g["_n"] / total for g in groups])
    drawn = spark.createDataFrame([(g["_g"], g["_n"], int(k)) for g, k in zip(groups, share) if k], "_g int, _of long, _k long")
    draws = drawn.repartition("_g").select("_g", "_of", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))).alias("_i")).select(
        "_g", F.least(F.floor(_uniform(seed, "_g", "_i") * F.col("_of")), F.col("_of") - 1).cast("long").alias("_at"))

    # a group's buckets begin at the sums of those before; the last one to begin before a draw is its bucket
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"), "_b")
    found = _latest(begins.select("_g", "_at", F.struct("_b", F.col("_at").alias("_from")).alias("_value")), draws, ["_g"])
    places = found.select(F.col("_value._b").alias("_b"), (F.col("_at") - F.col("_value._from")).alias("_at"))
    places = places.withColumn("_s", F.expr(f"_at div {SEGMENT}"))

    rows = df.select(bucket.alias("_b"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    rows = rows.join(places.select("_b").distinct(), "_b", "left_semi").groupBy("_b", "_row").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_b").orderBy(F.xxhash64("_row"), "_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    first, last = F.expr(f"_from div {SEGMENT}"), F.expr(f"(_from + _n - 1) div {SEGMENT}")
    rows = (rows.withColumn("_s", F.explode(F.sequence(first, last))).join(places.select("_b", "_s").distinct(), ["_b", "_s"], "left_semi")
            .select("_b", "_s", F.greatest(F.col("_from"), F.col("_s") * F.lit(SEGMENT)).alias("_at"), F.col("_row").alias("_value")))
    out = _latest(rows, places, ["_b", "_s"])
    return out.select(*[F.col("_value").getField(c).alias(c) for c in cols])


def _latest(values: DataFrame, at: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of ``at`` (keys, _at) with the ``_value`` of the last row of
    ``values`` (keys, _at, _value) that begins there or before."""
    kind = values.schema["_value"].dataType
    both = values.withColumn("_query", F.lit(0)).unionByName(
        at.select(*keys, "_at", F.lit(None).cast(kind).alias("_value"), F.lit(1).alias("_query")))
    so_far = Window.partitionBy(*keys).orderBy("_at", "_query").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far)).filter("_query = 1").drop("_query")


def tagged_split(df: DataFrame, weights: list[float], seed: int, name: str = "split") -> DataFrame:
    """X3 as one frame: each row tagged with the index of its split. A row's
    part hangs on its content, its number among equal rows and the seed: the
    same table in other files or partitions is split the same."""
    edge, total = F.lit(len(weights) - 1), sum(weights)
    for i in reversed(range(len(weights) - 1)):
        edge = F.when(F.col("_u") < sum(weights[:i + 1]) / total, i).otherwise(edge)
    return _dealt(df, seed).withColumn(name, edge).drop("_u")


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Disjoint, complete random split (e.g. 0.8 / 0.2), the same for any
    partitioning (see :func:`tagged_split`)."""
    tagged = tagged_split(df, weights, seed, "_split")
    return [tagged.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a reused frame cached for the ``with`` block, then drop it.
    Lost cached blocks are recomputed from lineage."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(n)
