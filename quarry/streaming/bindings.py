"""Streaming operators bound to the driver tables. Each query replays a
table (or files Spark derived from it) as a stream, runs it to the end of
the available input and returns the sink folder as a DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans import bindings as B
from quarry.plans.composed import text_lines
from quarry.schemas import PRODUCT_MESSAGE
from quarry.session import table_path, work_path
from quarry.sources.streams import lines_stream, messages_stream, table_stream
from quarry.streaming import jobs
from quarry.streaming.audit import read_audit, run_audited
from quarry.streaming.delivery import run_once_only
from quarry.streaming.tables import run_rows_and_counts, run_update

query = B.query


def _doc_lines_stream(spark, sf_dir):
    docs = table_stream(spark, table_path(sf_dir, "documents")).select("text")
    return text_lines(docs, "text")


@query("running_counts", B.ORACLE_SQL["word_count_nonempty"])
def running_counts(spark, sf_dir):
    """Cumulative word counts, complete mode, empty words dropped."""
    agg = jobs.running_word_count(_doc_lines_stream(spark, sf_dir))
    return jobs.run_complete(spark, agg, "running_counts")


@query("running_counts_sorted", B.ORACLE_SQL["word_count_nonempty"])
def running_counts_sorted(spark, sf_dir):
    """The same, sorted by count inside the complete-mode query."""
    agg = jobs.running_word_count(_doc_lines_stream(spark, sf_dir), sort=True)
    return jobs.run_complete(spark, agg, "running_counts_sorted")


@query("batch_words", f"""
SELECT word, count(*) AS count, 0 AS batch_id
FROM (SELECT unnest(string_split(value, ' ')) AS word FROM ({B.SQL_LINES}))
WHERE word <> ''
GROUP BY word
""")
def batch_words(spark, sf_dir):
    """Per-micro-batch word counts (one input file = batch 0)."""
    return jobs.batch_word_count(spark, _doc_lines_stream(spark, sf_dir), "batch_words")


def _event_payloads(spark, sf_dir):
    ev = table_stream(spark, table_path(sf_dir, "events"))
    return ev.select("event_id", F.encode("event_type", "UTF-8").alias("value"))


@query("stream_append", "SELECT event_id, event_type AS message FROM events")
def stream_append(spark, sf_dir):
    """T4: raw messages as text, append mode."""
    msgs = jobs.raw_messages(_event_payloads(spark, sf_dir), keep=["event_id"])
    return jobs.run_append(spark, msgs, "stream_append")


@query("product_stream", B.SQL_PRODUCT)
def product_stream_q(spark, sf_dir):
    """Framed JSON product messages: strip header, decode, flatten, append."""
    ev = table_stream(spark, table_path(sf_dir, "events"))
    framed = B._product_json(ev).select(
        "message_id", F.concat(F.unhex(F.lit("0000000001")), F.encode("payload", "UTF-8")).alias("value"))
    flat = jobs.product_stream(framed, PRODUCT_MESSAGE, keep=["message_id"])
    return jobs.run_append(spark, flat, "product_stream")


@query("landed_messages", """
SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS message FROM events
""")
def landed_messages(spark, sf_dir):
    """Messages landed as JSON files, read as a checkpointed stream."""
    landing = work_path(spark, "landing")
    ev = B._t(spark, sf_dir, "events")
    ev.select(F.col("event_id").cast("string").alias("message_id"),
              F.col("event_type").alias("message")).write.mode("overwrite").json(landing)
    return jobs.run_append(spark, messages_stream(spark, landing), "landed_messages")


@query("file_stream_words", B.ORACLE_SQL["word_count"])
def file_stream_words(spark, sf_dir):
    """S10 + T1: text files of a folder as a line stream, cumulative word
    counts with Java-split words (empties kept)."""
    folder = work_path(spark, "texts")
    B._t(spark, sf_dir, "documents").select("text").write.mode("overwrite").text(folder)
    agg = jobs.running_word_count(lines_stream(spark, folder), drop_empty=False, java_split=True)
    return jobs.run_complete(spark, agg, "file_stream_words")


@query("audit_events", """
SELECT count(*) AS records, CAST(1 AS BIGINT) AS started, CAST(1 AS BIGINT) AS completed, CAST(0 AS BIGINT) AS failed,
       CAST(1 AS BIGINT) AS runs, CAST(6 AS INTEGER) AS n_fields FROM events
""")
def audit_events(spark, sf_dir):
    """L2 K3: events stream written per micro-batch with START / RUNNING /
    COMPLETE rows in an audit table; what the audit says of the whole run."""
    ev = table_stream(spark, table_path(sf_dir, "events"))
    _, audit = run_audited(spark, ev, "events-audit", "events", table_path(sf_dir, "events"))
    kind = F.col("event_type")
    return read_audit(spark, audit).agg(
        F.sum(F.when(kind == "RUNNING", F.col("record_count"))).alias("records"),
        *[F.count_if(kind == k).alias(n) for k, n in (("START", "started"), ("COMPLETE", "completed"), ("FAIL", "failed"))],
        F.count_distinct("run_id").alias("runs"), F.max(F.size("fields")).alias("n_fields"))


@query("stream_pair", f"""
SELECT 'raw' AS kind, event_type AS value, count(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT 'count', event_type, count(*) FROM events GROUP BY event_type
""")
def stream_pair(spark, sf_dir):
    """T5: raw messages and running counts as two queries over one source."""
    ev = table_stream(spark, table_path(sf_dir, "events")).select(F.col("event_type").alias("value"))
    counts = ev.groupBy(F.col("value").alias("word")).agg(F.count(F.lit(1)).alias("count"))
    (raw, running), queries = jobs.start_pair(jobs.raw_messages(ev), counts, spark, "pair")
    for q in queries:
        q.awaitTermination()
    out = spark.read.parquet(raw).groupBy(F.col("message").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.lit("raw").alias("kind"), "value", "n").unionByName(
        spark.read.parquet(running).select(F.lit("count").alias("kind"), F.col("word").alias("value"),
                                           F.col("count").alias("n")))


@query("stream_recovery", "SELECT event_id, event_type AS message FROM events")
def stream_recovery(spark, sf_dir):
    """Half of the messages land and are processed, then the rest lands
    and a second run goes on from the first one's checkpoint."""
    landing, out = work_path(spark, "landing"), work_path(spark, "recovered")
    ev = B._t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("message"))
    got = None
    for half in (0, 1):
        ev.filter(F.pmod("event_id", F.lit(2)) == half).write.mode("append").json(landing)
        stream = messages_stream(spark, landing, schema=ev.schema)
        got = jobs.run_append(spark, stream, "recovered", out=out)
    return got


@query("batch_distinct_words", f"""
SELECT 0 AS batch_id, count(DISTINCT word) AS distinct_keys
FROM (SELECT unnest(string_split(value, ' ')) AS word FROM ({B.SQL_LINES}))
WHERE word <> ''
""")
def batch_distinct_words(spark, sf_dir):
    """Number of distinct words in each micro-batch."""
    per_batch = jobs.batch_word_count(spark, _doc_lines_stream(spark, sf_dir), "batch_distinct")
    return per_batch.groupBy("batch_id").agg(F.count(F.lit(1)).alias("distinct_keys"))


@query("delivered_once", "SELECT event_id, event_type AS message FROM events")
def delivered_once(spark, sf_dir):
    """Two deliveries that overlap in a third of the messages, the second
    one after a restart; every message comes out once."""
    landing, out = work_path(spark, "landing"), work_path(spark, "once")
    ev = B._t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("message"))
    third = F.pmod("event_id", F.lit(3))
    got = None
    for delivery in (third < 2, third > 0):
        ev.filter(delivery).write.mode("append").json(landing)
        got = run_once_only(spark, messages_stream(spark, landing, schema=ev.schema), "once", key="event_id", out=out)
    return got


def _landings(spark, sf_dir, thirds=3):
    """After each third of the documents has landed: the folder's lines as a
    stream."""
    folder = work_path(spark, "texts")
    docs = B._t(spark, sf_dir, "documents").select("doc_id", "text")
    for k in range(thirds):
        docs.filter(F.pmod("doc_id", F.lit(thirds)) == k).select("text").write.mode("append").option("compression", "zstd").parquet(folder)
        yield text_lines(spark.readStream.schema("text string").parquet(folder), "text")


@query("running_counts_changes", B.ORACLE_SQL["word_count_nonempty"])
def running_counts_changes(spark, sf_dir):
    """T1 in update mode: a batch writes the words it changed, in the buckets
    they fall in; three runs to one table, a merge of layers after two."""
    out, table = work_path(spark, "changes"), None
    for lines in _landings(spark, sf_dir):
        table = run_update(spark, jobs.running_word_count(lines), "running_counts_changes", ["word"], out=out, merge_after=2)
    return table.read(spark)


@query("rows_and_counts", f"""
SELECT 'row' AS kind, value, count(*) AS n FROM ({B.SQL_LINES}) GROUP BY value
UNION ALL
SELECT 'word', word, count(*) FROM (SELECT unnest(string_split(value, ' ')) AS word FROM ({B.SQL_LINES}))
WHERE word <> '' GROUP BY word
""")
def rows_and_counts(spark, sf_dir):
    """T5 from one read: the lines themselves and running word counts, both
    of the same committed batches."""
    out, both = work_path(spark, "both"), None
    for lines in _landings(spark, sf_dir):
        both = run_rows_and_counts(spark, lines, "rows_and_counts", lambda b: b.select("value"), jobs.running_word_count,
                                   ["word"], out=out, merge_after=2)
    lines = both.read_rows(spark).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    words = both.read_totals(spark).select(F.lit("word").alias("kind"), F.col("word").alias("value"), F.col("count").alias("n"))
    return lines.select(F.lit("row").alias("kind"), "value", "n").unionByName(words)


@query("stream_timed", "SELECT event_id, event_type AS message FROM events")
def stream_timed(spark, sf_dir):
    """Raw messages under a processing-time trigger, stopped when all
    that is there has been processed."""
    msgs = jobs.raw_messages(_event_payloads(spark, sf_dir), keep=["event_id"])
    return jobs.run_until_idle(spark, msgs, "stream_timed", "1 second")


@query("product_versions_stream", B.ORACLE_SQL["product_versions"])
def product_versions_stream(spark, sf_dir):
    """The same messages as a stream; version 2 is registered only
    after the first run, whose rejects are decoded again then."""
    from quarry.lineage.writers import accepted, decode_by_writer, live_writers, read_accepted, read_rejects, run_by_writer
    landing, out = work_path(spark, "framed"), work_path(spark, "versions")
    framed = B._framed_products(B._t(spark, sf_dir, "events"))
    known = {"v": 1}
    keep = {"message_id": "string"}

    def catalog(session):
        return B._product_catalog(session).filter(F.col("schemaVersion") <= known["v"])

    for half in (0, 1):
        framed.filter(F.pmod(F.col("message_id").cast("long"), F.lit(2)) == half).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(framed.schema).parquet(landing)
        run_by_writer(spark, stream, "versions", catalog, ["product-value"], keep=list(keep), out=out)
        known["v"] = 2
    writers = live_writers(catalog(spark), ["product-value"])
    again = decode_by_writer(read_rejects(spark, out, keep).filter(F.col("reject") == "unknown schema id"), writers, keep=list(keep))
    written = read_accepted(spark, out, writers, keep).withColumn("reject", F.lit(None).cast("string"))
    columns = ["message_id", "schema_version", "message", "reject"]
    return accepted(written.select(columns).unionByName(again.select(columns)), list(keep))
