"""Streaming sources (S9-S12) for Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.schemas import TEXT_MESSAGE
from quarry.sources.folders import is_folder


def kafka_options(servers: str, topic: str, group: str | None = None,
                  starting_offsets: str = "latest", **extra) -> dict:
    """S9 options. Only ``kafka.``-prefixed keys reach the consumer, so the
    consumer group is always passed as ``kafka.group.id``."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group:
        opts["kafka.group.id"] = group
    opts.update(extra)
    return opts


def kafka_stream(spark: SparkSession, servers: str, topic: str, group: str | None = None,
                 starting_offsets: str = "latest", **extra) -> DataFrame:
    """A Kafka topic as a stream (needs the spark-sql-kafka package)."""
    return (spark.readStream.format("kafka")
            .options(**kafka_options(servers, topic, group, starting_offsets, **extra))
            .load())


def lines_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files of a folder as a stream of lines (``value``).

    Unlike the legacy DStream file source, files already in the folder at
    start are read too.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a TCP socket (test/demo source, not fault tolerant)."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", str(port)).load())


def messages_stream(spark: SparkSession, landing_dir: str,
                    schema: T.StructType = TEXT_MESSAGE, fmt: str = "json",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Messages landed as files (``message_id``, payload) as a stream.

    Replaces a driver-side pull loop: producers land files, the checkpointed
    file source tracks what was processed, so nothing is acknowledged before
    it is durably handled.
    """
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing_dir)


def table_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 spread: bool = True) -> DataFrame:
    """A parquet table (one file or a folder) replayed as a stream.

    A single file is one micro-batch with one partition per row group, a
    layout known from its metadata when the plan is built. With ``spread``
    it is repartitioned to the cluster's cores when it has fewer row groups
    than that, the same rule as :func:`quarry.operators.spread` for batch
    input. A folder, on whatever file system, is streamed as is.
    """
    batch_view = spark.read.parquet(path)
    r = spark.readStream.schema(batch_view.schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if not is_folder(spark, path):
        d, _, f = path.rpartition("/")
        d = d or "."
        stream = r.option("pathGlobFilter", f).parquet(d)
        if spread:
            target = spark.sparkContext.defaultParallelism
            try:
                few = batch_view.rdd.getNumPartitions() < target
            except Exception:  # noqa: BLE001 - no RDD view: leave as is
                few = False
            if few:
                stream = stream.repartition(target)
        return stream
    return r.parquet(path)
