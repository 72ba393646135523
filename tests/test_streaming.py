import os
import tempfile

import pytest

from quarry.session import work_path
from quarry.sources.streams import lines_stream, messages_stream, table_stream
from quarry.streaming import jobs
from quarry.streaming.audit import compact_audit, read_audit, run_audited

MESSAGES = [
    "red green blue", "green and red", "first light", "red green grey",
    "grey or blue", "", "  padded  ", "and and and",
]


def _land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def _expected(lines):
    out = {}
    for ln in lines:
        for w in ln.split(" "):
            if w:
                out[w] = out.get(w, 0) + 1
    return out


def test_running_counts_survive_restart(spark):
    src = tempfile.mkdtemp()
    out, ckpt = work_path(spark, "t-out"), work_path(spark, "t-ckpt")
    _land(src, "a.txt", MESSAGES[:4])
    agg = jobs.running_word_count(lines_stream(spark, src))
    res = jobs.run_complete(spark, agg, "t", out=out, checkpoint=ckpt)
    assert {r.word: r["count"] for r in res.collect()} == _expected(MESSAGES[:4])
    _land(src, "b.txt", MESSAGES[4:])
    agg = jobs.running_word_count(lines_stream(spark, src))
    res = jobs.run_complete(spark, agg, "t", out=out, checkpoint=ckpt)
    assert {r.word: r["count"] for r in res.collect()} == _expected(MESSAGES)


def test_batch_counts_are_per_batch_and_idempotent(spark):
    src = tempfile.mkdtemp()
    out, ckpt = work_path(spark, "b-out"), work_path(spark, "b-ckpt")
    _land(src, "a.txt", MESSAGES[:4])
    jobs.batch_word_count(spark, lines_stream(spark, src), "b", out=out, checkpoint=ckpt)
    _land(src, "b.txt", MESSAGES[4:])
    res = jobs.batch_word_count(spark, lines_stream(spark, src), "b", out=out, checkpoint=ckpt)
    by_batch = {}
    for r in res.collect():
        by_batch.setdefault(r.batch_id, {})[r.word] = r["count"]
    assert by_batch == {0: _expected(MESSAGES[:4]), 1: _expected(MESSAGES[4:])}


def test_append_and_landed_messages(spark):
    landing = tempfile.mkdtemp()
    import json
    with open(os.path.join(landing, "m.json"), "w") as f:
        for i, m in enumerate(MESSAGES):
            f.write(json.dumps({"message_id": str(i), "message": m}) + "\n")
    out = jobs.run_append(spark, messages_stream(spark, landing), "landed")
    assert sorted(r.message for r in out.collect()) == sorted(MESSAGES)


def test_two_queries_on_one_source(spark):
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES)
    s = lines_stream(spark, src)
    (raw, counts), qs = jobs.start_pair(jobs.raw_messages(s), jobs.running_word_count(s), spark, "pair")
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(raw).count() == len(MESSAGES)
    assert {r.word: r["count"] for r in spark.read.parquet(counts).collect()} == _expected(MESSAGES)


def test_audited_sink_records_batches(spark):
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES[:5])
    data, audit = run_audited(spark, lines_stream(spark, src), "job", "texts", src)
    ev = read_audit(spark, audit).orderBy("event_time").collect()
    kinds = [e.event_type for e in ev]
    assert kinds[0] == "START" and kinds[-1] == "COMPLETE" and "RUNNING" in kinds
    running = [e for e in ev if e.event_type == "RUNNING"]
    assert sum(e.record_count for e in running) == 5 == spark.read.parquet(data).count()
    assert [(f.name, f.type) for f in running[0].fields] == [("value", "string")]


def test_trigger_kwargs():
    assert jobs.trigger_kwargs("5 seconds") == {"processingTime": "5 seconds"}
    assert jobs.trigger_kwargs("availableNow") == {"availableNow": True}


def test_audit_restart_adds_only_new_batches(spark):
    src = tempfile.mkdtemp()
    data, audit, ckpt = work_path(spark, "d"), work_path(spark, "a"), work_path(spark, "c")
    _land(src, "a.txt", MESSAGES[:3])
    run_audited(spark, lines_stream(spark, src), "job", "texts", src, data, audit, ckpt)
    _land(src, "b.txt", MESSAGES[3:])
    run_audited(spark, lines_stream(spark, src), "job", "texts", src, data, audit, ckpt)
    ev = read_audit(spark, audit).collect()
    running = sorted((e.batch_id, e.record_count) for e in ev if e.event_type == "RUNNING")
    assert running == [(0, 3), (1, len(MESSAGES) - 3)]
    assert sum(1 for e in ev if e.event_type == "START") == 2
    assert spark.read.parquet(data).count() == len(MESSAGES)


def test_foreach_batch_sink(spark):
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES)
    out = work_path(spark, "fe")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = jobs.start_foreach_batch(lines_stream(spark, src), write, work_path(spark, "fe-ckpt"),
                                 trigger="availableNow", name="fe_test")
    q.awaitTermination()
    assert spark.read.parquet(out).count() == len(MESSAGES)


def _checkpoint_without_last_commit(ckpt: str) -> str:
    """A copy of a checkpoint as it would be after a crash between writing
    a batch's output and recording its commit."""
    import shutil
    commits = sorted(int(f) for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit())
    last = str(commits[-1])
    copy = tempfile.mkdtemp() + "/ckpt"
    shutil.copytree(ckpt, copy, ignore=lambda d, names: [n for n in names if d.endswith("commits")
                                                           and n in (last, f".{last}.crc")])
    return copy


def test_replayed_uncommitted_batch_is_idempotent(spark):
    src = tempfile.mkdtemp()
    out, ckpt = work_path(spark, "r-out"), work_path(spark, "r-ckpt")
    data, audit, ackpt = work_path(spark, "r-data"), work_path(spark, "r-audit"), work_path(spark, "r-ack")
    _land(src, "a.txt", MESSAGES[:4])
    jobs.batch_word_count(spark, lines_stream(spark, src), "r", out=out, checkpoint=ckpt)
    run_audited(spark, lines_stream(spark, src), "job", "texts", src, data, audit, ackpt)
    _land(src, "b.txt", MESSAGES[4:])
    jobs.batch_word_count(spark, lines_stream(spark, src), "r", out=out, checkpoint=ckpt)
    run_audited(spark, lines_stream(spark, src), "job", "texts", src, data, audit, ackpt)
    # restart from checkpoints that lost batch 1's commit: batch 1 runs again
    res = jobs.batch_word_count(spark, lines_stream(spark, src), "r", out=out,
                                checkpoint=_checkpoint_without_last_commit(ckpt))
    run_audited(spark, lines_stream(spark, src), "job", "texts", src, data, audit,
                _checkpoint_without_last_commit(ackpt))
    by_batch = {}
    for r in res.collect():
        by_batch.setdefault(r.batch_id, {})[r.word] = r["count"]
    assert by_batch == {0: _expected(MESSAGES[:4]), 1: _expected(MESSAGES[4:])}
    running = sorted((e.batch_id, e.record_count) for e in read_audit(spark, audit).collect()
                     if e.event_type == "RUNNING")
    assert running == [(0, 4), (1, len(MESSAGES) - 4)]
    assert spark.read.parquet(data).count() == len(MESSAGES)
    events = read_audit(spark, audit).collect()
    last_run = max((e for e in events if e.event_type == "START"), key=lambda e: e.event_time).run_id
    replayed = [e for e in events if e.event_type == "RUNNING" and e.batch_id == 1]
    assert [e.run_id for e in replayed] == [last_run]  # batch 1 really ran again, once


def test_replayed_complete_mode_batch_rewrites_the_same_result(spark):
    src = tempfile.mkdtemp()
    out, ckpt = work_path(spark, "c-out"), work_path(spark, "c-ckpt")
    _land(src, "a.txt", MESSAGES[:4])
    jobs.run_complete(spark, jobs.running_word_count(lines_stream(spark, src)), "c", out=out, checkpoint=ckpt)
    _land(src, "b.txt", MESSAGES[4:])
    jobs.run_complete(spark, jobs.running_word_count(lines_stream(spark, src)), "c", out=out, checkpoint=ckpt)
    res = jobs.run_complete(spark, jobs.running_word_count(lines_stream(spark, src)), "c", out=out,
                            checkpoint=_checkpoint_without_last_commit(ckpt))
    assert {r.word: r["count"] for r in res.collect()} == _expected(MESSAGES)


def test_stream_word_count_scopes(spark):
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES[:4])
    ck_r, ck_b = work_path(spark, "s-r"), work_path(spark, "s-b")
    out_r, out_b = work_path(spark, "s-ro"), work_path(spark, "s-bo")
    jobs.stream_word_count(spark, lines_stream(spark, src), "running", out=out_r, checkpoint=ck_r)
    jobs.stream_word_count(spark, lines_stream(spark, src), "batch", out=out_b, checkpoint=ck_b)
    _land(src, "b.txt", MESSAGES[4:])
    run = jobs.stream_word_count(spark, lines_stream(spark, src), "running", out=out_r, checkpoint=ck_r)
    per = jobs.stream_word_count(spark, lines_stream(spark, src), "batch", out=out_b, checkpoint=ck_b)
    assert {r.word: r["count"] for r in run.collect()} == _expected(MESSAGES)
    assert {r.word: r["count"] for r in per.filter("batch_id = 1").collect()} == _expected(MESSAGES[4:])
    with pytest.raises(ValueError):
        jobs.stream_word_count(spark, lines_stream(spark, src), "daily")


def test_second_run_to_the_same_place_goes_on(spark):
    src, out = tempfile.mkdtemp(), work_path(spark, "again")
    _land(src, "a.txt", MESSAGES[:4])
    jobs.run_append(spark, lines_stream(spark, src), "again", out=out)
    _land(src, "b.txt", MESSAGES[4:])
    res = jobs.run_append(spark, lines_stream(spark, src), "again", out=out)
    assert sorted(r.value for r in res.collect()) == sorted(MESSAGES)
    counts = work_path(spark, "again-counts")
    jobs.batch_word_count(spark, lines_stream(spark, src), "w", out=counts)
    _land(src, "c.txt", ["one more"])
    per = jobs.batch_word_count(spark, lines_stream(spark, src), "w", out=counts)
    assert {(r.word, r.batch_id) for r in per.filter("batch_id = 1").collect()} == {("one", 1), ("more", 1)}
    assert per.filter("batch_id = 0").count() == len(_expected(MESSAGES))


def test_results_without_their_checkpoint_are_refused(spark):
    src, out = tempfile.mkdtemp(), work_path(spark, "orphan")
    _land(src, "a.txt", MESSAGES)
    spark.range(3).write.parquet(out)
    for run in (lambda s: jobs.run_append(spark, s, "x", out=out), lambda s: jobs.batch_word_count(spark, s, "x", out=out),
                lambda s: jobs.run_complete(spark, jobs.running_word_count(s), "x", out=out),
                lambda s: run_audited(spark, s, "x", "t", src, out)):
        with pytest.raises(ValueError, match="checkpoint"):
            run(lines_stream(spark, src))
    assert spark.read.parquet(out).count() == 3


def test_no_input_gives_empty_results(spark):
    src = tempfile.mkdtemp()
    s = lines_stream(spark, src)
    assert jobs.run_append(spark, s, "e").count() == 0
    assert jobs.run_complete(spark, jobs.running_word_count(s), "e").columns == ["word", "count"]
    assert jobs.batch_word_count(spark, s, "e").count() == 0


def test_pair_waits_even_after_earlier_queries(spark):
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES)
    jobs.run_append(spark, lines_stream(spark, src), "earlier")
    s = lines_stream(spark, src)
    _, qs = jobs.start_pair(jobs.raw_messages(s), jobs.running_word_count(s), spark, "pair2")
    assert not all(q.isActive for q in qs)
    for q in qs:
        q.awaitTermination()


def test_pair_times_out_and_processing_time_runs(spark):
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES)
    s = lines_stream(spark, src)
    with pytest.raises(TimeoutError):
        jobs.start_pair(jobs.raw_messages(s), jobs.running_word_count(s), spark, "pair3", "1 second", timeout=8)
    for q in spark.streams.active:
        assert q.recentProgress and q.recentProgress[0]["numInputRows"] == len(MESSAGES)
        q.stop()


def test_folder_tables_by_uri(spark):
    folder = work_path(spark, "table") + ".parquet"
    spark.range(100).repartition(4).write.parquet(folder)
    for path in (folder, folder if ":" in folder else f"file:{folder}"):
        assert jobs.run_append(spark, table_stream(spark, path), "t").count() == 100


def test_failure_is_logged_and_raised(spark):
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES)
    audit = work_path(spark, "fail-audit")
    bad = lines_stream(spark, src).selectExpr("raise_error('no') as x")
    with pytest.raises(Exception, match="no"):
        run_audited(spark, bad, "job", "texts", src, audit_path=audit)
    events = read_audit(spark, audit).orderBy("event_time").collect()
    assert [e.event_type for e in events] == ["START", "FAIL"] and "no" in events[1].error


def test_two_jobs_share_an_audit_table(spark):
    audit = work_path(spark, "shared-audit")
    for name, part in (("one", MESSAGES[:3]), ("two", MESSAGES[3:])):
        src = tempfile.mkdtemp()
        _land(src, "a.txt", part)
        run_audited(spark, lines_stream(spark, src), name, "texts", src, audit_path=audit)
    running = sorted((e.job, e.record_count) for e in read_audit(spark, audit).collect() if e.event_type == "RUNNING")
    assert running == [("one", 3), ("two", len(MESSAGES) - 3)]
    small = compact_audit(spark, audit, work_path(spark, "compact"))
    assert small.count() == 6 and len(small.inputFiles()) == 1


def test_catalogue_version_between_batches_shows(spark):
    src, place = tempfile.mkdtemp(), work_path(spark, "catalog")
    schema = "subject string, schemaId long, schemaVersion long, schemaType string, schema string"

    def version(n):
        doc = '{"type": "record", "name": "R", "fields": [%s]}' % ", ".join(
            f'{{"name": "f{i}", "type": "string", "doc": "d{i}"}}' for i in range(n))
        spark.createDataFrame([("texts-value", 10 + n, n, "AVRO", doc)], schema).write.mode("append").parquet(place)

    args = dict(job="job", source_name="texts", source_uri=src, data_path=work_path(spark, "cd"),
                audit_path=work_path(spark, "ca"), namespace="spaces", subject="texts-value", registry_url="http://r",
                catalog=lambda s: s.read.schema(schema).parquet(place))
    for n, part in ((1, MESSAGES[:3]), (2, MESSAGES[3:])):
        version(n)
        _land(src, f"{n}.txt", part)
        run_audited(spark, lines_stream(spark, src), **args)
    running = sorted((e.batch_id, e.registry.schemaVersion, [(f.name, f.description) for f in e.fields], e.namespace)
                     for e in read_audit(spark, args["audit_path"]).collect() if e.event_type == "RUNNING")
    assert running == [(0, 1, [("f0", "d0")], "spaces"), (1, 2, [("f0", "d0"), ("f1", "d1")], "spaces")]


def test_audit_counts_while_writing(spark, monkeypatch):
    """No batch is counted by a job of its own or read back."""
    from pyspark.sql import DataFrame
    src = tempfile.mkdtemp()
    _land(src, "a.txt", MESSAGES)

    def refused(self):
        raise AssertionError("counted apart")

    stream = lines_stream(spark, src)
    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1)), "count", refused)
        m.setattr(DataFrame, "count", refused)
        _, audit = run_audited(spark, stream, "counted", "texts", src)
    running = [r for r in read_audit(spark, audit).collect() if r.event_type == "RUNNING"]
    assert [r.record_count for r in running] == [len(MESSAGES)]
