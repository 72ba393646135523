"""Joins (J1-J5, J8) and cogroup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.chunks import CHUNK_ROWS, large_keys, list_with_nulls, split_by, value_chunks
from quarry.operators.hot import ERROR, MOST_TRACKED, frequent_keys

#: Rows of a key that are never worth splitting.
MIN_HOT_ROWS = 10_000


def join_by_key(left: DataFrame, right: DataFrame, on, how: str = "inner",
                strategy: str | None = None) -> DataFrame:
    """Equi-join on one or more shared key columns.

    By default the strategy is Catalyst's (broadcast by statistics, else
    sort-merge; AQE re-plans at run time and splits skewed partitions).
    ``strategy="shuffle_hash"`` suits a ``right`` side with one row per key
    that grows with the data (a per-key aggregate): each task hashes its
    share of ``right``, bounded by key count whatever the skew of ``left``,
    and the large side is never sorted.
    """
    if strategy:
        right = right.hint(strategy)
    return left.join(right, on=on, how=how)


def join_split(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Inner or left join that deals the rows of hot keys of ``right`` over
    several tasks, for joins the engine can't split by itself: the right side
    of a left join, or a side that meets an aggregate.

    A key is hot if it has more than half of what a task gets on average, so
    there are at most two hot keys for each task; only they are broadcast. One
    pass over ``right`` names them (see :mod:`quarry.operators.hot`). Their rows
    in ``right`` are salted by a hash of their content, and the ``left`` rows
    of the key (few, such as the one row of an aggregate) are repeated for
    every salt.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_split does inner and left joins")
    on = [on] if isinstance(on, str) else list(on)
    spark = right.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tracked = 16 * parts

    def above(rows: int) -> int:  # no lower than what the largest sketch can tell
        return max(MIN_HOT_ROWS, -(-rows // (2 * parts)), int(ERROR * rows / MOST_TRACKED))

    _, limit, hot = frequent_keys(right.select(*on), on, above, tracked)
    rows = hot.dropna(subset=on).select(*on, F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("_salts")).collect() if hot else []
    if not rows:  # there are at most 2 * parts
        return left.join(right, on, how)
    kinds = [right.schema[c] for c in on]
    small = F.broadcast(spark.createDataFrame(rows, T.StructType([*kinds, T.StructField("_salts", T.IntegerType())])))
    salt = F.pmod(F.xxhash64(*[right[c] for c in right.columns]), F.coalesce("_salts", F.lit(1))).cast("int")
    big = right.join(small, on, "left").withColumn("_salt", salt).drop("_salts").withColumn("_here", F.lit(True))
    few = (left.join(small, on, "left")
           .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))))
    out = few.join(big, [*on, "_salt"], how)
    if how == "left":  # a hot key has rows in ``right``, if not under every salt
        out = out.filter(F.col("_salts").isNull() | F.col("_here").isNotNull())
    return out.drop("_salts", "_salt", "_here")


def cogroup(left: DataFrame, right: DataFrame, on: str | list[str],
            left_values: str | list[str], right_values: str | list[str],
            chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """For every key found on either side, both sides' value lists.

    Returns ``(keys..., chunk, left, right)``, lists sorted, nulls first. Row
    ``chunk`` of a key holds the values from ``chunk * chunk_rows`` on of
    either side, ``chunk_rows`` of each at most; a side that has no more, or
    lacks the key, has an empty list. The lists of a key's rows, in order of
    chunk, are its whole lists.
    """
    keys = [on] if isinstance(on, str) else list(on)
    lv, rv = ([v] if isinstance(v, str) else list(v) for v in (left_values, right_values))
    a = left.select(*keys, (F.col(lv[0]) if len(lv) == 1 else F.struct(*lv)).alias("_l"))
    b = right.select(*keys, (F.col(rv[0]) if len(rv) == 1 else F.struct(*rv)).alias("_r"))
    ltype, rtype = a.schema["_l"].dataType.simpleString(), b.schema["_r"].dataType.simpleString()

    def whole(x: DataFrame, y: DataFrame) -> DataFrame:
        tagged = (x.select(*keys, F.lit(0).alias("_side"), "_l", F.lit(None).cast(rtype).alias("_r"))
                  .unionByName(y.select(*keys, F.lit(1).alias("_side"), F.lit(None).cast(ltype).alias("_l"), "_r")))
        return tagged.groupBy(*keys).agg(
            list_with_nulls("_l", ltype, F.col("_side") == 0).alias("left"),
            list_with_nulls("_r", rtype, F.col("_side") == 1).alias("right")).select(
            *keys, F.lit(0).cast("long").alias("chunk"), "left", "right")

    found = [x for x in (large_keys(a, keys, chunk_rows), large_keys(b, keys, chunk_rows)) if x is not None]
    if not found:
        return whole(a, b)
    large = found[0] if len(found) == 1 else found[0].unionByName(found[1]).distinct()
    (a, big_a), (b, big_b) = split_by(a, large, keys), split_by(b, large, keys)
    x = value_chunks(big_a, keys, "_l", "left", chunk_rows).withColumn("right", F.lit(None).cast(f"array<{rtype}>"))
    y = value_chunks(big_b, keys, "_r", "right", chunk_rows).withColumn("left", F.lit(None).cast(f"array<{ltype}>"))
    # one row of each side at most: grouping treats null keys as equal
    cut = x.unionByName(y).groupBy(*keys, "chunk").agg(
        F.coalesce(F.any_value("left", F.lit(True)), F.array().cast(f"array<{ltype}>")).alias("left"),
        F.coalesce(F.any_value("right", F.lit(True)), F.array().cast(f"array<{rtype}>")).alias("right"))
    return whole(a, b).unionByName(cut)
