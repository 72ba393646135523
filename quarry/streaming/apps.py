"""Streaming jobs in the shape of the reference programs. The Kafka jobs
need the spark-sql-kafka (and, for Avro, spark-avro) packages; the folder
and socket jobs run with Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.schemas import PRODUCT_MESSAGE
from quarry.session import work_path
from quarry.sources.streams import kafka_stream, lines_stream, messages_stream, socket_stream
from quarry.lineage.writers import start_by_writer
from quarry.streaming import jobs
from quarry.streaming.audit import run_audited
from quarry.streaming.tables import start_rows_and_counts, start_update


def kafka_word_count_job(spark: SparkSession, servers: str, topic: str, group: str,
                         raw_out: str, counts_out: str, checkpoint: str,
                         trigger: str = "5 seconds", starting_offsets: str = "latest"):
    """Raw messages (append) and running word counts (complete, empty words
    dropped) from one topic; returns both started queries."""
    src = kafka_stream(spark, servers, topic, group, starting_offsets)
    raw = jobs.raw_messages(src)
    counts = jobs.running_word_count(raw, "message")
    q1 = jobs.start_query(raw, "append", "parquet", "kafka-messages", trigger, f"{checkpoint}/raw", raw_out)
    w = (counts.writeStream.outputMode("complete").queryName("kafka-word-count")
         .option("checkpointLocation", f"{checkpoint}/counts")
         .foreachBatch(jobs.overwrite_each_batch(counts_out)).trigger(**jobs.trigger_kwargs(trigger)))
    return q1, w.start()


def rows_and_counts_job(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str,
                        trigger: str | None = "5 seconds", name: str = "rows-and-counts"):
    """The same two results from one read of the stream, always of the same
    batches and restartable between any two writes; (results, query). For a
    topic, pass ``kafka_stream(...)``."""
    def counts(batch: DataFrame) -> DataFrame:
        return jobs.running_word_count(jobs.raw_messages(batch), "message")

    return start_rows_and_counts(spark, stream, name, jobs.raw_messages, counts, ["word"], trigger=trigger, out=out,
                                 checkpoint=checkpoint)


def running_word_changes_job(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str,
                             trigger: str | None = "5 seconds", buckets: int = 32):
    """Running word counts whose batches write only the words they changed;
    (table, query)."""
    counts = jobs.running_word_count(jobs.raw_messages(stream), "message")
    return start_update(spark, counts, "running-word-changes", ["word"], trigger=trigger, out=out, checkpoint=checkpoint, buckets=buckets)


def products_by_writer_job(spark: SparkSession, stream: DataFrame, catalog, subjects: list[str], out: str, checkpoint: str,
                           codec: str = "avro", trigger: str | None = "5 seconds", keep: list[str] | None = None):
    """Product messages, each decoded under the schema id in its header, and
    a reject table; (result folder, query)."""
    return start_by_writer(spark, stream, "products-by-writer", catalog, subjects, keep=keep, codec=codec, trigger=trigger,
                           out=out, checkpoint=checkpoint)


def kafka_product_job(spark: SparkSession, servers: str, topic: str, group: str, schema,
                      out: str, checkpoint: str, codec: str = "avro", header_bytes: int = 5,
                      trigger: str = "5 seconds"):
    """Product messages: strip the wire header, decode (Avro schema JSON or
    a JSON payload schema), flatten, append to ``out``."""
    src = kafka_stream(spark, servers, topic, group)
    flat = jobs.product_stream(src, schema, "value", header_bytes, codec)
    return jobs.start_query(flat, "append", "parquet", "kafka-products", trigger, checkpoint, out)


def audited_product_job(spark: SparkSession, stream: DataFrame, job: str, source_name: str,
                        source_uri: str, schema=PRODUCT_MESSAGE, codec: str = "json",
                        header_bytes: int = 5, trigger: str = "availableNow", **paths):
    """Decoded product messages written per micro-batch with run events
    (START / RUNNING per batch with count and schema fields / COMPLETE)."""
    flat = jobs.product_stream(stream, schema, "value", header_bytes, codec)
    return run_audited(spark, flat, job, source_name, source_uri, trigger=trigger, **paths)


def folder_word_count_job(spark: SparkSession, directory: str, out: str | None = None,
                          checkpoint: str | None = None, trigger: str = "availableNow") -> DataFrame:
    """Word counts of each micro-batch of new text files (not cumulative)."""
    return jobs.batch_word_count(spark, lines_stream(spark, directory), "folder-words", drop_empty=False,
                                 trigger=trigger, out=out, checkpoint=checkpoint)


def socket_word_count_job(spark: SparkSession, host: str, port: int, out: str, checkpoint: str,
                          trigger: str = "5 seconds"):
    """Per-batch word counts and distinct-word counts of a TCP text stream
    (demo source). Writes ``out/counts/batch_id=n`` and
    ``out/distinct/batch_id=n``."""
    words = (socket_stream(spark, host, port)
             .select(F.explode(F.split("value", " ")).alias("word")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
        counts.write.mode("overwrite").parquet(f"{out}/counts/batch_id={batch_id}")
        distinct = spark.read.parquet(f"{out}/counts/batch_id={batch_id}").agg(
            F.count(F.lit(1)).alias("distinct_words"))
        distinct.write.mode("overwrite").parquet(f"{out}/distinct/batch_id={batch_id}")

    return jobs.start_foreach_batch(words, per_batch, checkpoint, trigger=trigger, name="socket-words")


def landed_word_count_job(spark: SparkSession, landing_dir: str, out: str | None = None,
                          checkpoint: str | None = None, trigger: str = "availableNow") -> DataFrame:
    """Messages landed as files: cumulative word counts, most frequent first."""
    agg = jobs.running_word_count(messages_stream(spark, landing_dir), "message", sort=True)
    return jobs.run_complete(spark, agg, "landed-words", trigger, out or work_path(spark, "landed-words"),
                             checkpoint)
