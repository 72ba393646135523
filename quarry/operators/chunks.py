"""Per-key value lists in chunks.

Every value of a key, sorted, is cut into lists of ``chunk_rows`` values:
chunk 0 holds the first ones, and the chunks of a key end to end are its
whole sorted list. The caller chooses the size; it is the same for all keys
and at any amount of data.

A key that fits one list is grouped as such. Of the others, equal values are
counted first (a partial aggregate), so what is ranked is one row per key and
distinct value, and a large key's rows never meet as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.hot import frequent_keys
from quarry.session import work_path

#: Values in a list, unless the caller asks for another size.
CHUNK_ROWS = 100_000
#: Distinct values of one key that a single task may rank. A key with more is
#: ranked in ranges of its values; the result is the same.
RANK_ROWS = 1_000_000


def ranked_runs(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys..., value, _n, _start): each distinct value of a key, how often
    it occurs and how many of the key's values sort before it (nulls first)."""
    pairs = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    most = df.count()  # no key has more distinct values than there are rows
    if most > RANK_ROWS:
        most = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")).agg(F.max("m")).first()[0] or 0
    order = F.col(value).asc_nulls_first()
    if most <= RANK_ROWS:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return pairs.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # ranges of (key, value), written so that a row's range holds for good
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    path = work_path(spark, "ranges")
    (pairs.repartitionByRange(parts, *[F.col(k).asc_nulls_first() for k in keys], order)
     .withColumn("_range", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.schema(T.StructType([*pairs.schema.fields, T.StructField("_range", T.IntegerType())])).parquet(path)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_all")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
        F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_base"))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & ranged[k].eqNullSafe(base[f"_k{i}"])
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(base, same)
            .withColumn("_start", F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
            .select(*keys, value, "_n", "_start"))


def value_chunks(df: DataFrame, keys: list[str], value: str, out: str, chunk_rows: int) -> DataFrame:
    """(keys..., chunk, out): sorted lists of ``chunk_rows`` values, the last
    one of a key shorter."""
    size = F.lit(int(chunk_rows))
    first, last = F.floor(F.col("_start") / size), F.floor((F.col("_start") + F.col("_n") - 1) / size)
    cut = ranked_runs(df, keys, value).withColumn("chunk", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("_start"), F.col("chunk") * size)
    end = F.least(F.col("_start") + F.col("_n"), (F.col("chunk") + 1) * size)
    run = F.struct(begin.alias("at"), F.array_repeat(F.col(value), (end - begin).cast("int")).alias("v"))
    lists = F.flatten(F.transform(F.sort_array(F.collect_list(run)), lambda r: r["v"]))
    return cut.groupBy(*keys, "chunk").agg(lists.alias(out))


def list_with_nulls(value: str, dtype: str, present: Column | None = None) -> Column:
    """Aggregate: ``value`` (of SQL type ``dtype``) over the rows where
    ``present`` holds (all rows when None) as a sorted list, nulls first
    (``collect_list`` leaves them out, so they are counted apart)."""
    v = F.col(value)
    lst = F.sort_array(F.collect_list(v if present is None else F.when(present, v)))
    n_null = F.count_if(v.isNull() if present is None else (present & v.isNull())).cast("int")
    return F.when(n_null == 0, lst).otherwise(F.concat(F.array_repeat(F.lit(None).cast(dtype), n_null), lst))


def large_keys(df: DataFrame, keys: list[str], chunk_rows: int) -> DataFrame | None:
    """The keys that need more than one list; None if there are none."""
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    _, _, large = frequent_keys(df.select(*keys), keys, lambda rows: chunk_rows)
    return None if large is None or large.isEmpty() else large.select(*keys)


def split_by(df: DataFrame, large: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the other keys, rows of the ``large`` keys); null keys equal."""
    marks = large.select(*[F.col(f"`{k}`").alias(f"_l{i}") for i, k in enumerate(keys)])
    same = None
    for i, k in enumerate(keys):
        e = df[f"`{k}`"].eqNullSafe(marks[f"_l{i}"])
        same = e if same is None else (same & e)
    return df.join(marks, same, "left_anti"), df.join(marks, same, "left_semi")


def grouped_lists(df: DataFrame, keys: str | list[str], values: str | list[str],
                  out: str = "values", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A7 / groupByKey: ``(keys..., chunk, out)`` where ``out`` lists the
    key's values, sorted, nulls first, in chunks of ``chunk_rows``.

    With one value column the list holds plain values, with several it holds
    structs.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [values] if isinstance(values, str) else list(values)
    v = F.col(values[0]) if len(values) == 1 else F.struct(*values)
    src = df.select(*keys, v.alias("_v"))
    dtype = src.schema["_v"].dataType.simpleString()

    def whole(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(list_with_nulls("_v", dtype).alias(out)).select(
            *keys, F.lit(0).cast("long").alias("chunk"), out)

    large = large_keys(src, keys, chunk_rows)
    if large is None:
        return whole(src)
    small, big = split_by(src, large, keys)
    return whole(small).unionByName(value_chunks(big, keys, "_v", out, chunk_rows))
