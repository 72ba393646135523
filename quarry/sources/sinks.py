"""Sinks (K1, K4): result folders and model persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources.files import EXACT_CSV, mark_nulls
from quarry.sources.folders import replace


def write_result(df: DataFrame, path: str, fmt: str = "parquet", num_files: int | None = None,
                 partition_by: list[str] | None = None, **options) -> None:
    """K1: replace a result folder; a write that fails leaves the old result
    (see :func:`quarry.sources.folders.replace`).

    ``num_files`` narrows the output with ``coalesce`` (no shuffle); leave it
    unset at scale so every task writes its own file. ``fmt="tuples"``
    writes text lines ``(a,b,..)``. ``fmt="csv"`` quotes what needs it, so
    ``read_delimited(exact=True)`` gets every string back.
    """
    out = df.coalesce(num_files) if num_files else df
    if fmt == "tuples":
        # one "(a,b,...)" text line per row, as saveAsTextFile prints tuples
        out = out.select(F.concat(F.lit("("), F.concat_ws(",", *[F.col(c).cast("string") for c in out.columns]),
                                  F.lit(")")).alias("value"))
        fmt = "text"
    if fmt == "csv":
        out = mark_nulls(out)
        options = {**{k: v for k, v in EXACT_CSV.items() if k != "multiLine"}, "emptyValue": '""', **options}
    w = out.write.format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    replace(df.sparkSession, path, w.save)


def write_bucketed(df: DataFrame, table: str, by: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """K1: a catalogue table dealt by a hash of ``by`` into ``buckets`` files,
    each sorted by it; replaces a table of that name. Two tables with the same
    buckets and keys of the same types join and group on them without a
    shuffle. Size the buckets as a task's work. All rows of one key are in one
    bucket: where a key is hot, join with ``join_split`` instead."""
    spark = df.sparkSession
    w = (df.repartition(buckets, *[F.col(f"`{c}`") for c in by]).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, *by).sortBy(*by))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return spark.table(table)


def save_model(model, path: str) -> None:
    """K4: persist a fitted Spark ML model, replacing an older copy."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    """K4: reload a model saved with :func:`save_model` (``cls`` is the Model class)."""
    return cls.load(path)
