"""Partition helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy row work (tokenising long texts) at least
    ``min_partitions`` tasks (default: the cluster's cores).

    Only acts when the input has fewer partitions than that (e.g. one large
    row group); an input already split into many files or row groups is
    returned unchanged, so on large data this costs nothing. The
    round-robin repartition is made deterministic by Spark (local sort
    before partitioning), so recomputed tasks get the same rows. Streams are
    left as they are unless ``min_partitions`` is given, and so is a frame
    with a shuffle in its plan: that has as many tasks as the shuffle, and
    asking how many would run it.
    """
    if df.isStreaming:
        # a micro-batch's partition count is unknown when the plan is built;
        # a file stream with many files per trigger is already split, so
        # repartition only when the caller asks for a count explicitly
        return df.repartition(min_partitions) if min_partitions else df
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return df.repartition(min_partitions) if min_partitions else df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): leave as is
        return df
    return df.repartition(target) if current < target else df
