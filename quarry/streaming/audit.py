"""L2: run events (START, RUNNING per micro-batch, COMPLETE or FAIL) in an
audit table while a stream is written.

Each RUNNING row records the batch id, the number of records the batch
wrote, and its schema. With a schema catalogue, that is the subject's latest
version at the time of the batch, so a version added between two batches
shows in the next row; without one, it is the batch's own columns.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.lineage.catalog import latest_schema
from quarry.lineage.documents import schema_field_rows
from quarry.sources import folders

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("namespace", T.StringType()),
    T.StructField("job", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_uri", T.StringType()),
    T.StructField("fields", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
        T.StructField("description", T.StringType())]))),
    # the job's kind, and the catalogue entry behind ``fields``
    T.StructField("processing_type", T.StringType()),
    T.StructField("registry", T.StructType([
        T.StructField("url", T.StringType()), T.StructField("subject", T.StringType()),
        T.StructField("schemaId", T.LongType()), T.StructField("schemaVersion", T.LongType()),
        T.StructField("schemaType", T.StringType())])),
    T.StructField("error", T.StringType()),
])


def schema_field_list(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """Dotted leaf fields of a Spark schema (metadata only)."""
    out = []
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out.extend(schema_field_list(f.dataType, name + "."))
        else:
            out.append((name, f.dataType.simpleString()))
    return out


def _write_event(spark: SparkSession, audit_path: str, key: str, row: tuple) -> None:
    """Write one audit event to its own folder, replacing an earlier copy:
    a micro-batch replayed after a failure rewrites its RUNNING row instead
    of adding a second one."""
    (spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{audit_path}/{key}"))


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """All events of an audit table."""
    return spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", "true").parquet(audit_path)


def compact_audit(spark: SparkSession, audit_path: str, out: str, num_files: int = 1) -> DataFrame:
    """The events of an audit table in ``num_files`` files at ``out`` (an
    event is a small file of its own until then)."""
    folders.replace(spark, out, lambda new: read_audit(spark, audit_path).coalesce(num_files).write.parquet(new))
    return read_audit(spark, out)


def run_audited(spark: SparkSession, stream: DataFrame, job: str, source_name: str,
                source_uri: str, data_path: str | None = None, audit_path: str | None = None,
                checkpoint: str | None = None, trigger: str = "availableNow", namespace: str = "default",
                catalog: Callable[[SparkSession], DataFrame] | None = None, subject: str | None = None,
                registry_url: str | None = None):
    """Write ``stream`` to ``data_path`` (one ``batch_id=n`` folder per
    micro-batch, overwritten on replay) and log run events to
    ``audit_path``. Empty batches are logged too. A failure is logged as FAIL
    with its message and raised. Returns ``(data_path, audit_path)``; read
    the events with :func:`read_audit`.

    ``catalog`` gives the schema catalogue, asked anew for every batch, and
    ``subject`` the entry of this stream. RUNNING rows are keyed by the query
    id that the checkpoint holds and the batch id: replays replace their row,
    and several jobs may share an audit table. A batch's records are counted
    by the job that writes them.
    """
    from quarry.streaming.jobs import output_places, trigger_kwargs
    from quarry.session import work_path

    data_path, checkpoint = output_places(spark, job, data_path, checkpoint)
    audit_path = audit_path or work_path(spark, f"{job}-audit")
    run_id = str(uuid.uuid4())
    query_id: list[str] = []

    def event(session: SparkSession, kind: str, key: str, schema: T.StructType, batch_id: int | None = None,
              count: int | None = None, error: str | None = None) -> None:
        fields = [(a, b, "") for a, b in schema_field_list(schema)]
        registry = None
        if catalog is not None:
            entry = latest_schema(catalog(session).filter(F.col("subject") == subject)).first()
            if entry is not None:
                fields = schema_field_rows(entry["schema"])
                registry = (registry_url, subject, entry["schemaId"], entry["schemaVersion"], entry["schemaType"])
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        _write_event(session, audit_path, key, (
            run_id, namespace, job, kind, now, batch_id, count, source_name, source_uri,
            [T.Row(name=a, type=b, description=c) for a, b, c in fields], "STREAMING", registry, error))

    event(spark, "START", f"start-{run_id}", stream.schema)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        target = f"{data_path}/batch_id={batch_id}"
        seen = Observation()
        batch.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
        n = seen.get["n"]
        if not query_id:  # written before the first batch starts
            query_id.append(json.loads(folders.read_text(batch.sparkSession, f"{checkpoint}/metadata").splitlines()[-1])["id"])
        event(batch.sparkSession, "RUNNING", f"batch-{query_id[0]}-{batch_id:012d}", batch.schema, int(batch_id), int(n))

    try:
        q = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(per_batch)
             .trigger(**trigger_kwargs(trigger)).start())
        q.awaitTermination()
    except BaseException as e:
        event(spark, "FAIL", f"fail-{run_id}", stream.schema, error=f"{type(e).__name__}: {e}"[:2000])
        raise
    event(spark, "COMPLETE", f"complete-{run_id}", stream.schema)
    return data_path, audit_path
