"""Aggregations (A1-A18). All are algebraic, so Spark runs a partial
(map-side) aggregate before the shuffle and a hot key costs one row per
task, not all its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.chunks import CHUNK_ROWS, grouped_lists


def _keys(k) -> list:
    return [k] if isinstance(k, (str, Column)) else list(k)


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    """A1: number of rows, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, **predicates: Column) -> DataFrame:
    """A2: several predicate counts in a single pass (``name=predicate``)."""
    return df.agg(*[F.count_if(p).alias(n) for n, p in predicates.items()])


def group_count(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """Rows per key (keys may be expressions, aliased)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


count_by_key = group_count


def count_by_value(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Occurrences of each value of a column."""
    return group_count(df, [col], name)


def group_mean(df: DataFrame, keys, value: str, name: str = "avg_value") -> DataFrame:
    """A4: mean of ``value`` per key."""
    return df.groupBy(*_keys(keys)).agg(F.avg(value).alias(name))


def sum_by_key(df: DataFrame, keys, value: str, name: str = "total") -> DataFrame:
    """A5: sum per key (combined map-side, like reduceByKey)."""
    return df.groupBy(*_keys(keys)).agg(F.sum(value).alias(name))


def mean_by_key(df: DataFrame, keys, value: str, name: str = "mean") -> DataFrame:
    """Mean per key from (sum, count) pairs."""
    return (df.groupBy(*_keys(keys))
            .agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
            .select(*[k for k in _keys(keys)], (F.col("_s") / F.col("_c")).alias(name)))


def collect_by_key(df: DataFrame, keys, value: str, out: str = "values",
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A key's values as sorted lists of ``chunk_rows`` values."""
    return grouped_lists(df, _keys(keys), value, out, chunk_rows)


def total(df: DataFrame, col: str, zero=None, name: str = "total") -> DataFrame:
    """Global sum. ``zero`` given = fold (empty input -> zero);
    without it an empty input gives null (reduce)."""
    s = F.sum(col)
    if zero is not None:
        s = F.coalesce(s, F.lit(zero))
    return df.agg(s.alias(name))


def sum_count_mean(df: DataFrame, col: str) -> DataFrame:
    """(sum, count) in one pass and their ratio."""
    return (df.agg(F.sum(col).alias("total"), F.count(col).alias("count"))
            .withColumn("mean", F.col("total") / F.col("count")))


def global_max(df: DataFrame, expr: Column, name: str = "max_value") -> DataFrame:
    """Maximum of an expression over all rows."""
    return df.agg(F.max(expr).alias(name))


def distinct_values(df: DataFrame, cols=None) -> DataFrame:
    """Distinct rows (of ``cols`` when given)."""
    return (df.select(*_keys(cols)) if cols else df).distinct()


def distinct_key_count(df: DataFrame, keys, name: str = "distinct_keys") -> DataFrame:
    """Number of distinct keys."""
    return df.agg(F.count_distinct(*[F.col(k) for k in _keys(keys)]).alias(name))


def mean_squared_error(df: DataFrame, actual: str, predicted: str, name: str = "mse") -> DataFrame:
    """Mean of squared differences of two columns."""
    d = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(d * d).alias(name))
