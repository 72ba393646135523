"""Results of streams as tables of changes.

A running aggregate in ``update`` mode hands over only the keys that a
micro-batch changed. They are written as one more layer of the hash buckets
they fall in; a bucket with many layers is merged into one. A version of the
table is a small file that names the layers of every bucket, written last and
under the number of the batch: readers see whole versions, and a batch that
is replayed finds its version there and does nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import folders
from quarry.streaming.jobs import output_places, trigger_kwargs


class Versions:
    """Numbered JSON documents in a folder, each written once."""

    def __init__(self, path: str):
        self.path = path

    def numbers(self, spark: SparkSession) -> list[int]:
        return sorted(int(n[:-5]) for n in folders.names(spark, self.path) if n.endswith(".json") and n[0] != ".")

    def read(self, spark: SparkSession, number: int) -> dict:
        return json.loads(folders.read_text(spark, f"{self.path}/{number:012d}.json"))

    def exists(self, spark: SparkSession, number: int) -> bool:
        return folders.exists(spark, f"{self.path}/{number:012d}.json")

    def write(self, spark: SparkSession, number: int, document: dict) -> bool:
        return folders.write_text_once(spark, f"{self.path}/{number:012d}.json", json.dumps(document))

    def delete(self, spark: SparkSession, number: int) -> None:
        folders.delete(spark, f"{self.path}/{number:012d}.json")


class ChangeTable:
    """Rows by key in ``buckets`` hash buckets under ``path``.

    ``layers`` maps a bucket's number to its layers, oldest first; a layer's
    rows replace rows of the same key in older ones. ``merge_after`` layers a
    bucket are merged into one. The number of buckets belongs to the table:
    choose it so that a bucket's rows are a task's work.
    """

    def __init__(self, path: str, schema: T.StructType, keys: list[str], buckets: int = 32, merge_after: int = 8):
        if any(f.name in ("layer", "bucket") for f in schema.fields):
            raise ValueError("columns named layer or bucket are the table's own")
        self.path, self.schema, self.keys = path.rstrip("/"), schema, list(keys)
        self.buckets, self.merge_after = buckets, merge_after
        self.versions = Versions(f"{self.path}/versions")

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, version: int, kind: str) -> tuple[str, list[int]]:
        """One file for each bucket that has rows; which these are."""
        layer = f"{version:012d}-{kind}-{uuid.uuid4().hex[:8]}"
        target = f"{self._data}/layer={layer}"
        parts = min(self.buckets, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows.repartition(parts, "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(target)
        return layer, [int(n.partition("=")[2]) for n in folders.names(rows.sparkSession, target) if n.startswith("bucket=")]

    def _rows(self, spark: SparkSession, layers: dict[str, list[str]]) -> DataFrame:
        """The newest row of every key, with its bucket."""
        kind = T.StructType([*self.schema.fields, T.StructField("layer", T.StringType()), T.StructField("bucket", T.IntegerType())])

        def scan(some: dict[str, list[str]]) -> DataFrame:
            paths = [f"{self._data}/layer={x}/bucket={b}" for b, names in some.items() for x in names]
            if not paths:
                return spark.createDataFrame([], kind)
            return spark.read.schema(kind).option("basePath", self._data).parquet(*paths)

        columns = [f.name for f in self.schema.fields]
        whole = scan({b: x for b, x in layers.items() if len(x) == 1}).select(*columns, "bucket")
        layered = {b: x for b, x in layers.items() if len(x) > 1}
        if not layered:
            return whole
        values = [c for c in columns if c not in self.keys]
        newest = (scan(layered).groupBy(*self.keys, "bucket")
                  .agg(F.max_by(F.struct(*values) if values else F.lit(1), "layer").alias("newest"))  # names sort by version
                  .select(*[F.col("newest").getField(c).alias(c) if c in values else F.col(c) for c in columns], "bucket"))
        return whole.unionByName(newest)

    def latest(self, spark: SparkSession, before: int | None = None) -> dict:
        """The newest version's document (below ``before``), or an empty one."""
        known = [n for n in self.versions.numbers(spark) if before is None or n < before]
        return self.versions.read(spark, known[-1]) if known else {"version": None, "layers": {}}

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The table as of a version still kept, the newest by default."""
        at = self.latest(spark) if version is None else self.versions.read(spark, version)
        return self._rows(spark, at["layers"]).drop("bucket")

    def staged(self, rows: DataFrame, version: int, base: dict) -> dict:
        """Write ``rows`` (one a key) as the layer that makes ``version`` of
        ``base``; the document to commit. Nothing refers to it yet."""
        spark = rows.sparkSession
        columns = [f.name for f in self.schema.fields]
        layer, touched = self._write(self._bucketed(rows.select(*columns)), version, "change")
        layers = {b: list(x) for b, x in base["layers"].items()}
        for b in touched:
            layers.setdefault(str(b), []).append(layer)
        due = {b: x for b, x in layers.items() if len(x) > self.merge_after}
        if due:
            merged, filled = self._write(self._rows(spark, due), version, "merged")
            layers.update({str(b): [merged] for b in filled})
        return {"version": version, "layers": layers, "touched": sorted(touched)}

    def upsert(self, rows: DataFrame, version: int, keep: int = 10) -> None:
        """Commit ``rows`` as ``version``; a version that is there already
        was written by an earlier run of the same batch and stays."""
        spark = rows.sparkSession
        if self.versions.exists(spark, version):
            return
        self.versions.write(spark, version, self.staged(rows, version, self.latest(spark, version)))
        self.tidy(spark, keep)

    def added(self, changes: DataFrame, version: int, base: dict) -> dict:
        """As :meth:`staged`, with the values (one number for each key and
        value column) added to those of ``base``. Only the buckets that the
        changes fall in are read."""
        spark = changes.sparkSession
        columns = [f.name for f in self.schema.fields]
        values = [c for c in columns if c not in self.keys]
        changes = self._bucketed(changes.select(*columns)).persist()
        try:
            touched = {str(r["bucket"]) for r in changes.select("bucket").distinct().collect()}
            old = self._rows(spark, {b: x for b, x in base["layers"].items() if b in touched})
            both = old.withColumn("layer", F.lit(0)).unionByName(changes.withColumn("layer", F.lit(1)))
            total = (both.groupBy(*self.keys)
                     .agg(F.max("layer").alias("layer"), *[F.sum(v).cast(self.schema[v].dataType).alias(v) for v in values])
                     .filter("layer = 1"))
            return self.staged(total, version, base)
        finally:
            changes.unpersist()

    def tidy(self, spark: SparkSession, keep: int = 10) -> None:
        """Delete versions but the last ``keep``, and layers none of them has
        (replaced by a merge, or left by a batch that failed)."""
        known = self.versions.numbers(spark)
        for n in known[:-keep]:
            self.versions.delete(spark, n)
        if known:
            self.forget(spark, [self.versions.read(spark, n) for n in known[-keep:]])

    def forget(self, spark: SparkSession, documents: list[dict]) -> None:
        """Delete the layers that none of the documents names."""
        used = {x for d in documents for names in d["layers"].values() for x in names}
        for name in folders.names(spark, self._data):
            if name.startswith("layer=") and name[6:] not in used:
                folders.delete(spark, f"{self._data}/{name}")


def start_update(spark: SparkSession, aggregate: DataFrame, name: str, keys: list[str], trigger: str | None = "availableNow",
                 out: str | None = None, checkpoint: str | None = None, buckets: int = 32, merge_after: int = 8):
    """T1 / T2 without rewriting the result: start a streaming aggregation by
    ``keys`` in update mode into a :class:`ChangeTable` at ``out``. Returns
    (table, query)."""
    out, checkpoint = output_places(spark, name, out, checkpoint)
    table = ChangeTable(out, aggregate.schema, keys, buckets, merge_after)
    query = (aggregate.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(lambda batch, n: table.upsert(batch, n)).trigger(**trigger_kwargs(trigger)).start())
    return table, query


def run_update(spark: SparkSession, aggregate: DataFrame, name: str, keys: list[str], **places) -> ChangeTable:
    """:func:`start_update`, until the available input is consumed."""
    table, query = start_update(spark, aggregate, name, keys, **places)
    query.awaitTermination()
    return table


class RowsAndCounts:
    """T5: the rows of a stream and running totals over them, from one read.

    ``rows`` and ``changes`` turn a micro-batch into the rows to keep and into
    what to add to the totals (one row a key). Both are written from the same
    batch, and one commit record of the application and batch makes both
    visible: :meth:`read_rows` and :meth:`read_totals` are always of the same
    batches. A batch that stopped between the two writes is done again and
    replaces what it left.
    """

    def __init__(self, out: str, application: str, rows_schema: T.StructType, totals_schema: T.StructType, keys: list[str],
                 buckets: int = 32, merge_after: int = 8):
        self.out, self.application, self.rows_schema = out.rstrip("/"), application, rows_schema
        self.commits = Versions(f"{self.out}/commits/{application}")
        self.totals = ChangeTable(f"{self.out}/totals", totals_schema, keys, buckets, merge_after)

    def _last(self, spark: SparkSession, before: int | None = None) -> dict:
        known = [n for n in self.commits.numbers(spark) if before is None or n < before]
        return self.commits.read(spark, known[-1]) if known else {"batch": -1, "totals": {"version": None, "layers": {}}}

    def write(self, batch: DataFrame, number: int, rows: Callable[[DataFrame], DataFrame],
              changes: Callable[[DataFrame], DataFrame], keep: int = 10) -> None:
        spark = batch.sparkSession
        if self.commits.exists(spark, number):
            return
        batch = batch.persist()
        try:
            rows(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.out}/rows/batch={number}")
            totals = self.totals.added(changes(batch), number, self._last(spark, number)["totals"])
        finally:
            batch.unpersist()
        self.commits.write(spark, number, {"application": self.application, "batch": number, "totals": totals})
        known = self.commits.numbers(spark)
        for n in known[:-keep]:
            self.commits.delete(spark, n)
        self.totals.forget(spark, [self.commits.read(spark, n)["totals"] for n in known[-keep:]])

    def read_rows(self, spark: SparkSession) -> DataFrame:
        """The rows of the committed batches, with their batch."""
        folders.make(spark, f"{self.out}/rows")
        schema = T.StructType([*self.rows_schema.fields, T.StructField("batch", T.LongType())])
        return spark.read.schema(schema).parquet(f"{self.out}/rows").filter(F.col("batch") <= self._last(spark)["batch"])

    def read_totals(self, spark: SparkSession) -> DataFrame:
        return self.totals._rows(spark, self._last(spark)["totals"]["layers"]).drop("bucket")


def start_rows_and_counts(spark: SparkSession, stream: DataFrame, name: str, rows: Callable[[DataFrame], DataFrame],
                          changes: Callable[[DataFrame], DataFrame], keys: list[str], trigger: str | None = "availableNow",
                          out: str | None = None, checkpoint: str | None = None, buckets: int = 32, merge_after: int = 8):
    """Start a stream into :class:`RowsAndCounts`; a run to the same ``out``
    goes on where the last one ended. Returns (results, query)."""
    out, checkpoint = output_places(spark, name, out, checkpoint)
    both = RowsAndCounts(out, name, rows(stream).schema, changes(stream).schema, keys, buckets, merge_after)
    query = (stream.writeStream.option("checkpointLocation", checkpoint)
             .foreachBatch(lambda b, n: both.write(b, n, rows, changes)).trigger(**trigger_kwargs(trigger)).start())
    return both, query


def run_rows_and_counts(spark: SparkSession, stream: DataFrame, name: str, rows: Callable[[DataFrame], DataFrame],
                        changes: Callable[[DataFrame], DataFrame], keys: list[str], **places) -> RowsAndCounts:
    """:func:`start_rows_and_counts`, until the available input is consumed."""
    both, query = start_rows_and_counts(spark, stream, name, rows, changes, keys, **places)
    query.awaitTermination()
    return both
