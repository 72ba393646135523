"""Streaming word counts, raw and decoded message streams, query start-up.

Tests and registered queries drive streams with ``availableNow`` triggers;
production uses ``processingTime``. Every query has a checkpoint folder, so
a restart resumes exactly where the last committed batch ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.binary import decode_payload, strip_header
from quarry.functions.nested import flatten_struct
from quarry.plans.composed import words
from quarry.session import work_path
from quarry.sources import folders


def trigger_kwargs(trigger: str | None) -> dict:
    """``"5 seconds"`` -> processing-time trigger; ``"availableNow"``,
    ``"once"`` or ``None`` (default micro-batching)."""
    if trigger is None:
        return {}
    if trigger == "availableNow":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def start_query(df: DataFrame, mode: str = "append", fmt: str = "parquet", name: str | None = None,
                trigger: str | None = None, checkpoint: str | None = None, path: str | None = None,
                **options):
    """K2: start a streaming query with an output mode, sink format, name,
    trigger and checkpoint folder."""
    w = df.writeStream.outputMode(mode).format(fmt).options(**options)
    if name:
        w = w.queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    tk = trigger_kwargs(trigger)
    if tk:
        w = w.trigger(**tk)
    return w.start(path) if path else w.start()


def start_foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "append",
                        trigger: str | None = None, name: str | None = None):
    """K3: call ``fn(batch_df, batch_id)`` for every micro-batch. ``fn``
    should be idempotent per ``batch_id`` (a batch is replayed after a
    failure before its commit was recorded)."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    if name:
        w = w.queryName(name)
    tk = trigger_kwargs(trigger)
    return (w.trigger(**tk) if tk else w).start()


def running_word_count(lines: DataFrame, col: str = "value", drop_empty: bool = True,
                       java_split: bool = False, sort: bool = False) -> DataFrame:
    """Cumulative word counts over the whole stream (state store),
    for ``complete`` output; ``sort`` orders by count (allowed in complete
    mode)."""
    counts = (words(lines, col, drop_empty, java_split=java_split)
              .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
    return counts.orderBy(F.col("count").desc(), F.col("word")) if sort else counts


def raw_messages(stream: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """T4: message payload as text (``CAST(value AS STRING)``)."""
    return stream.select(*(keep or []), F.col(value).cast("string").alias("message"))


def product_stream(stream: DataFrame, schema: T.StructType, value: str = "value",
                   header_bytes: int = 5, codec: str = "json", keep: list[str] | None = None) -> DataFrame:
    """Strip the wire header, decode the payload, flatten the message."""
    payload = strip_header(value, header_bytes) if header_bytes else F.col(value)
    dec = stream.select(*(keep or []), decode_payload(payload, schema, codec).alias("m"))
    return flatten_struct(dec, "m", keep=keep)


def output_places(spark: SparkSession, name: str, out: str | None, checkpoint: str | None) -> tuple[str, str]:
    """(result folder, checkpoint) of a stream. The checkpoint belongs to the
    result: it lies beside a given ``out``, so a second run to the same place
    goes on where the first one ended. A result whose checkpoint is gone is
    refused: batches would start from 0 and replace or skip what is there."""
    if out is None:
        return work_path(spark, f"{name}-out"), checkpoint or work_path(spark, f"{name}-ckpt")
    checkpoint = checkpoint or out.rstrip("/") + ".checkpoint"
    if folders.holds_files(spark, out) and not folders.exists(spark, checkpoint):
        raise ValueError(f"{out} holds results, but its checkpoint {checkpoint} does not exist: "
                         "give that run's checkpoint or another result folder")
    return out, checkpoint


def read_output(spark: SparkSession, out: str, schema) -> DataFrame:
    """The result folder with a known schema, so a stream that had no input
    gives an empty frame."""
    folders.make(spark, out)
    return spark.read.schema(schema).parquet(out)


def run_append(spark: SparkSession, df: DataFrame, name: str, trigger: str = "availableNow",
               out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run an append-mode stream into a parquet folder (exactly-once file
    sink) until the available input is consumed; return the folder as a
    batch DataFrame."""
    out, ckpt = output_places(spark, name, out, checkpoint)
    q = start_query(df, "append", "parquet", None, trigger, ckpt, out)
    q.awaitTermination()
    return read_output(spark, out, df.schema)


def run_until_idle(spark: SparkSession, df: DataFrame, name: str, trigger: str = "5 seconds",
                   out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run an append-mode stream under a processing-time trigger until it
    has processed all that has arrived, then stop it between two batches."""
    out, ckpt = output_places(spark, name, out, checkpoint)
    q = start_query(df, "append", "parquet", None, trigger, ckpt, out)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return read_output(spark, out, df.schema)


def overwrite_each_batch(path: str):
    """``foreachBatch`` function that replaces ``path`` with each batch
    (complete-mode results: every batch is the whole current state, and a
    replayed batch rewrites the same result). The old result stays until the
    new one is written."""
    def write(batch: DataFrame, batch_id: int) -> None:
        folders.replace(batch.sparkSession, path, lambda new: batch.write.parquet(new))
    return write


def run_complete(spark: SparkSession, df: DataFrame, name: str, trigger: str = "availableNow",
                 out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run a complete-mode aggregation; each micro-batch replaces the result
    folder with the full current state (a replayed batch rewrites the same
    result). Returns the folder as a batch DataFrame."""
    out, ckpt = output_places(spark, name, out, checkpoint)
    w = (df.writeStream.outputMode("complete").option("checkpointLocation", ckpt)
         .foreachBatch(overwrite_each_batch(out)).trigger(**trigger_kwargs(trigger)))
    w.start().awaitTermination()
    return read_output(spark, out, df.schema)


BATCH_COUNTS = "word string, count long, batch_id int"


def batch_word_count(spark: SparkSession, lines: DataFrame, name: str, col: str = "value",
                     drop_empty: bool = True, trigger: str = "availableNow",
                     out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Word counts of each micro-batch on its own (not cumulative).

    Batch ``n`` is written to ``out/batch_id=n`` with overwrite, so a batch
    replayed after a failure replaces its own output instead of adding to
    it. Returns ``(word, count, batch_id)``.
    """
    out, ckpt = output_places(spark, name, out, checkpoint)
    w = words(lines, col, drop_empty, java_split=False)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
        counts.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (w.writeStream.option("checkpointLocation", ckpt).foreachBatch(per_batch)
     .trigger(**trigger_kwargs(trigger)).start().awaitTermination())
    return read_output(spark, out, BATCH_COUNTS)


def stream_word_count(spark: SparkSession, lines: DataFrame, scope: str = "running",
                      name: str = "word-count", col: str = "value", drop_empty: bool = True,
                      trigger: str = "availableNow", out: str | None = None,
                      checkpoint: str | None = None) -> DataFrame:
    """Word counts of a line stream. ``scope="running"``: cumulative over
    the whole stream (complete mode, state store). ``scope="batch"``: each
    micro-batch counted on its own, tagged with ``batch_id``. Returns the
    result folder as a batch DataFrame."""
    if scope == "running":
        agg = running_word_count(lines, col, drop_empty)
        return run_complete(spark, agg, name, trigger, out, checkpoint)
    if scope == "batch":
        return batch_word_count(spark, lines, name, col, drop_empty, trigger, out, checkpoint)
    raise ValueError("scope must be 'running' or 'batch'")


def start_pair(first: DataFrame, second: DataFrame, spark: SparkSession, name: str,
               trigger: str | None = "availableNow", timeout: float | None = 600,
               out: str | None = None, checkpoint: str | None = None):
    """T5: two queries over one source (raw append + running complete) into
    ``out``/raw and ``out``/counts, going on where earlier ones to the same
    ``out`` ended (:mod:`quarry.streaming.tables` has both from one read);
    then wait until either ends (queries that ended before do not count).
    Raises the failure of the one that ended, or ``TimeoutError`` with both
    still running. Returns (outputs, queries)."""
    (out1, ckpt1), (out2, ckpt2) = (
        output_places(spark, f"{name}-{k}", f"{out.rstrip('/')}/{k}" if out else None, f"{checkpoint.rstrip('/')}/{k}" if checkpoint else None)
        for k in ("raw", "counts"))
    spark.streams.resetTerminated()
    q1 = start_query(first, "append", "parquet", None, trigger, ckpt1, out1)
    w2 = (second.writeStream.outputMode("complete").option("checkpointLocation", ckpt2)
          .foreachBatch(overwrite_each_batch(out2)))
    tk = trigger_kwargs(trigger)
    q2 = (w2.trigger(**tk) if tk else w2).start()
    waited = 0.0
    while q1.isActive and q2.isActive:
        if timeout is not None and waited >= timeout:
            raise TimeoutError(f"neither query of {name} ended within {timeout} s")
        q1.awaitTermination(0.2)
        waited += 0.2
    for q in (q1, q2):
        if not q.isActive:
            q.awaitTermination()  # raises if it failed
    return (out1, out2), (q1, q2)
