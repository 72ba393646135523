"""Keys with many rows, found in one pass.

Each task keeps a frequent-items sketch of fixed size over the hashes of its
keys; merged, they name every hash that may have more rows than asked for.
Only these few are counted exactly, and if there are none the table is read
once and nothing is shuffled but the sketches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that a sketch tracks at least, and at most.
LEAST_TRACKED, MOST_TRACKED = 4_096, 1_000_000
#: A sketch of m keys over n rows is sure to name keys of over n * this / m rows.
ERROR = 5.25


def frequent_keys(df: DataFrame, on: list[str], above: Callable[[int], int], tracked: int = LEAST_TRACKED
                  ) -> tuple[int, int, DataFrame | None]:
    """(rows, bound, keys): the keys with more than ``bound = above(rows)``
    rows as (on..., _n) with their exact number, None if there are none. Null
    keys count as equal. A bound too low for the largest sketch is met by
    counting all keys.
    """
    tracked = min(max(tracked, LEAST_TRACKED), MOST_TRACKED)
    key = F.xxhash64(*[F.col(f"`{c}`") for c in on])
    found = df.select(key.alias("_hash")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_hash, {tracked // 5}, {tracked})").alias("top")).first()
    rows, bound = found["n"], above(found["n"])
    if rows <= bound:
        return rows, bound, None
    if bound < ERROR * rows / tracked:
        counted = df
    else:
        likely = [(t["item"],) for t in found["top"] if t["count"] > bound]  # estimates are never too low
        if not likely:
            return rows, bound, None
        few = F.broadcast(df.sparkSession.createDataFrame(likely, "_hash long"))  # up to a fifth of the tracked keys
        counted = df.withColumn("_hash", key).join(few, "_hash", "left_semi")
    return rows, bound, counted.groupBy(*[F.col(f"`{c}`") for c in on]).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bound)
