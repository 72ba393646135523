"""Messages that a broker delivers more than once.

A reader that acknowledges late gets a message again; one that acknowledges
early loses it. Landed files keep every delivery, and keyed state forgets the
repeated ones: a message is let through when its id is not among the ids of
the last ``within``, which are all that the state holds.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.streaming.jobs import output_places, read_output, start_query

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started in the block keep their state in RocksDB, on the
    executors' disks and the checkpoint, so it may outgrow their memory."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def delivered_once(stream: DataFrame, key: str = "message_id", within: str = "7 days",
                   time: str | None = None) -> DataFrame:
    """The stream without the deliveries of a message after its first one.

    ``within`` is how long after the first delivery the broker may repeat it;
    the state drops ids after that. The clock is the arrival of micro-batches
    (recorded in the checkpoint, so a replay sees the same), which never makes
    a message late. With ``time``, an event-time column, it is the messages'
    own clock: then Spark drops, as late, any message older than the newest
    one by more than ``within`` (:func:`late_rows` counts them).

    Messages without an id are told apart by their whole content. Of copies
    in one batch any one stays.
    """
    missing = F.when(F.col(f"`{key}`").isNull(), F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns])), 256))
    keyed = stream.select(F.struct(*[F.col(f"`{c}`") for c in stream.columns]).alias("row"),
                          F.struct(F.col(f"`{key}`").alias("id"), missing.alias("content")).alias("delivery"),
                          (F.current_timestamp() if time is None else F.col(f"`{time}`")).alias("clock"))
    once = keyed.withWatermark("clock", within).dropDuplicatesWithinWatermark(["delivery"])
    return once.select(*[F.col("row").getField(c).alias(c) for c in stream.columns])


def late_rows(query) -> int:
    """Rows that a query's recent batches dropped as late."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def run_once_only(spark: SparkSession, stream: DataFrame, name: str, key: str = "message_id", within: str = "7 days",
                  time: str | None = None, trigger: str = "availableNow", out: str | None = None,
                  checkpoint: str | None = None) -> DataFrame:
    """Append every message once to a parquet folder until the available
    input is consumed. The ids seen are part of the checkpoint, so a second
    run to the same ``out`` knows the first one's. Late rows (with ``time``
    only) raise: they are in no result."""
    out, checkpoint = output_places(spark, name, out, checkpoint)
    with rocksdb_state(spark):
        q = start_query(delivered_once(stream, key, within, time), "append", "parquet", None, trigger, checkpoint, out)
    q.awaitTermination()
    late = late_rows(q)
    if late:
        raise RuntimeError(f"{name}: {late} messages were older than the newest by more than {within} and are not in {out}")
    return read_output(spark, out, stream.schema)
