"""Reading inputs and cutting lineage through the shared work folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import send_code, table_path, work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_code(spark)
    return spark.read.parquet(table_path(sf_dir, name))


#: With it a query's shuffle files go when the query ends, not when the driver
#: happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_noted: ContextVar[tuple[list[str], ...]] = ContextVar("folders that written() makes", default=())


@contextmanager
def only_last_kept(spark: SparkSession) -> Iterator[None]:
    """Of the folders that are written meanwhile only the last stays: nothing
    that was made from the others may be read later."""
    made: list[str] = []
    token = _noted.set((*_noted.get(), made))
    try:
        yield
    finally:
        _noted.reset(token)
        for path in made[:-1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back, so a
    lost executor never makes later stages compute it again. The shuffle files
    it took go at once."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    for made in _noted.get():
        made.append(path)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(docs: DataFrame, key: Column) -> DataFrame:
    """(key, doc): every row as one struct beside its key, so that no column
    of the rows, whatever its name, meets an operator's own."""
    return docs.select(key.alias("key"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))


def unboxed(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The rows' columns again, some of them with another value."""
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("doc").getField(c).alias(c) for c in columns])
