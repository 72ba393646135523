import json
import os
import tempfile

import pytest

from quarry.session import work_path
from quarry.sources import folders
from quarry.sources.streams import lines_stream, messages_stream
from quarry.streaming import jobs
from quarry.streaming.delivery import ROCKSDB, delivered_once, rocksdb_state, run_once_only
from quarry.streaming.tables import ChangeTable, RowsAndCounts, run_rows_and_counts, run_update

TIMED = "message_id string, message string, at timestamp"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def said(i, text=None):
    return {"message_id": i, "message": text or f"m{i}"}


def test_redelivered_messages_come_once_across_a_restart(spark):
    landing, out = tempfile.mkdtemp(), work_path(spark, "once")
    land(landing, "a.json", [said("1"), said("2"), said("2"), said("3")])
    run_once_only(spark, messages_stream(spark, landing), "once", out=out)
    land(landing, "b.json", [said("3"), said("1", "sent again"), said("4")])
    got = run_once_only(spark, messages_stream(spark, landing), "once", out=out)
    assert sorted((r.message_id, r.message) for r in got.collect()) == [("1", "m1"), ("2", "m2"), ("3", "m3"), ("4", "m4")]


def test_messages_without_id_are_told_apart_by_content(spark):
    landing = tempfile.mkdtemp()
    land(landing, "a.json", [said(None, "x"), said(None, "y"), said(None, "x"), {"message_id": None, "message": None}, said("", "x")])
    got = run_once_only(spark, messages_stream(spark, landing), "once")
    assert sorted(map(str, ((r.message_id, r.message) for r in got.collect()))) == sorted(map(str, [
        (None, "x"), (None, "y"), (None, None), ("", "x")]))


def test_event_time_window_forgets_and_reports_late_rows(spark):
    landing, out = tempfile.mkdtemp(), work_path(spark, "once")

    def run(name, rows):
        land(landing, name, [{"message_id": i, "message": "m", "at": t} for i, t in rows])
        return run_once_only(spark, messages_stream(spark, landing, schema=_type()), "once", within="1 hour", time="at", out=out)

    def _type():
        return spark.createDataFrame([], TIMED).schema

    run("a.json", [("1", "2024-01-01T00:00:00Z"), ("2", "2024-01-01T00:30:00Z")])
    got = run("b.json", [("1", "2024-01-01T00:20:00Z"), ("3", "2024-01-01T06:00:00Z")])
    assert sorted(r.message_id for r in got.collect()) == ["1", "2", "3"]
    got = run("c.json", [("1", "2024-01-01T06:10:00Z")])  # long after the window: a new message
    assert sorted(r.message_id for r in got.collect()) == ["1", "1", "2", "3"]
    with pytest.raises(RuntimeError, match="1 messages were older"):
        run("d.json", [("9", "2024-01-01T01:00:00Z")])


def test_state_is_kept_in_rocksdb_and_the_setting_restored(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with rocksdb_state(spark):
        assert spark.conf.get(key) == ROCKSDB
    assert spark.conf.get(key) == before
    landing, ckpt = tempfile.mkdtemp(), work_path(spark, "once-ckpt")
    land(landing, "a.json", [said("1")])
    run_once_only(spark, messages_stream(spark, landing), "once", checkpoint=ckpt)
    state = ckpt + "/state/0/0"
    assert any(n.endswith((".zip", ".changelog")) for n in folders.names(spark, state))
    assert delivered_once(messages_stream(spark, landing)).columns == ["message_id", "message"]


# ------------------------------------------------------------ change tables

WORDS = "word string, count long"


def table(spark, **kw):
    return ChangeTable(work_path(spark, "changes"), spark.createDataFrame([], WORDS).schema, ["word"], **kw)


def rows(spark, **counts):
    return spark.createDataFrame(list(counts.items()), WORDS)


def content(df):
    return {r["word"]: r["count"] for r in df.collect()}


def test_versions_hold_the_newest_row_of_every_key(spark):
    t = table(spark, buckets=4)
    t.upsert(rows(spark, a=1, b=1), 0)
    t.upsert(rows(spark, b=5, c=1), 1)
    t.upsert(rows(spark, a=2).limit(0), 2)
    assert content(t.read(spark)) == {"a": 1, "b": 5, "c": 1}
    assert content(t.read(spark, 0)) == {"a": 1, "b": 1}
    assert table(spark).read(spark).collect() == []


def test_a_batch_writes_only_the_buckets_it_touches(spark):
    t = table(spark, buckets=16)
    t.upsert(spark.range(500).selectExpr("concat('w', id) AS word", "1L AS count"), 0)
    first = t.latest(spark)
    assert len(first["touched"]) == 16
    t.upsert(rows(spark, w7=2), 1)
    second = t.latest(spark)
    assert len(second["touched"]) == 1
    changed = [b for b in second["layers"] if second["layers"][b] != first["layers"][b]]
    assert changed == [str(second["touched"][0])]
    new = {x for x in folders.names(spark, t.path + "/data")} - {f"layer={x}" for v in first["layers"].values() for x in v}
    assert len(new) == 1
    assert [n for n in folders.names(spark, f"{t.path}/data/{new.pop()}") if n.startswith("bucket=")] == [f"bucket={changed[0]}"]
    assert content(t.read(spark))["w7"] == 2 and t.read(spark).count() == 500


def test_merges_keep_the_rows_and_old_layers_go(spark):
    t = table(spark, buckets=2, merge_after=3)
    expected = {}
    for n in range(12):
        new = {f"k{i}": n for i in range(n % 5, 20, 3)}
        expected |= new
        t.upsert(rows(spark, **new), n, keep=2)
        assert content(t.read(spark)) == expected
        assert all(len(x) <= 3 for x in t.latest(spark)["layers"].values())
    assert t.versions.numbers(spark) == [10, 11]
    used = {x for n in (10, 11) for v in t.versions.read(spark, n)["layers"].values() for x in v}
    assert set(folders.names(spark, t.path + "/data")) == {f"layer={x}" for x in used}


def test_a_replayed_batch_changes_nothing(spark):
    t = table(spark)
    t.upsert(rows(spark, a=1), 0)
    t.upsert(rows(spark, a=2), 1)
    before = folders.names(spark, t.path + "/data")
    t.upsert(rows(spark, a=2), 1)
    assert folders.names(spark, t.path + "/data") == before and content(t.read(spark)) == {"a": 2}


def test_additions_read_only_touched_buckets(spark):
    t = table(spark, buckets=8)
    base = {"version": None, "layers": {}}
    one = t.staged(rows(spark, a=1, b=2, c=3), 0, base)
    two = t.added(rows(spark, b=5, d=1), 1, one)
    assert content(t._rows(spark, two["layers"])) == {"a": 1, "b": 7, "c": 3, "d": 1}
    assert content(t._rows(spark, one["layers"])) == {"a": 1, "b": 2, "c": 3}


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        ChangeTable("x", spark.createDataFrame([], "layer int, n int").schema, ["layer"])


LINES = ["red green blue", "green and red", "", "red", "blue blue"]


def expected(lines):
    out = {}
    for w in " ".join(lines).split():
        out[w] = out.get(w, 0) + 1
    return out


def test_update_mode_equals_complete_counts_over_restarts(spark):
    src, out = tempfile.mkdtemp(), work_path(spark, "updates")
    for i, line in enumerate(LINES):
        land(src, f"{i}.txt", [line])
        t = run_update(spark, jobs.running_word_count(lines_stream(spark, src)), "updates", ["word"], out=out, buckets=4, merge_after=2)
        assert content(t.read(spark)) == expected(LINES[:i + 1])


class Stop(Exception):
    pass


def test_rows_and_counts_agree_after_a_stop_between_the_writes(spark):
    src, out = tempfile.mkdtemp(), work_path(spark, "both")
    land(src, "a.txt", LINES[:3])

    def keep(b):
        return b.select("value")

    def run(counts):
        return run_rows_and_counts(spark, lines_stream(spark, src), "both", keep, counts, ["word"], out=out)

    both = run(jobs.running_word_count)
    land(src, "b.txt", LINES[3:])
    calls = []

    def failing(b):  # the first call only tells the schema
        calls.append(1)
        if len(calls) > 1:
            raise Stop("between the writes")
        return jobs.running_word_count(b)

    with pytest.raises(Exception, match="between the writes"):
        run(failing)
    assert "batch=1" in folders.names(spark, out + "/rows")
    assert both.read_rows(spark).count() == 3 and content(both.read_totals(spark)) == expected(LINES[:3])
    both = run(jobs.running_word_count)
    assert sorted(r.value for r in both.read_rows(spark).collect()) == sorted(LINES)
    assert content(both.read_totals(spark)) == expected(LINES)


def test_a_committed_batch_is_not_counted_twice(spark):
    batch = spark.createDataFrame([(x,) for x in LINES], "value string")
    both = RowsAndCounts(work_path(spark, "both"), "app", batch.schema, spark.createDataFrame([], WORDS).schema, ["word"])
    for _ in range(2):
        both.write(batch, 0, lambda b: b, jobs.running_word_count)
    other = RowsAndCounts(both.out, "app", batch.schema, both.totals.schema, ["word"])
    assert content(other.read_totals(spark)) == expected(LINES) and other.read_rows(spark).count() == len(LINES)


def test_run_until_idle_under_a_processing_time_trigger(spark):
    src = tempfile.mkdtemp()
    land(src, "a.txt", LINES)
    got = jobs.run_until_idle(spark, lines_stream(spark, src, max_files_per_trigger=1), "idle", "200 milliseconds")
    assert got.count() == len(LINES)


def test_two_queries_go_on_in_the_same_place(spark):
    src, out = tempfile.mkdtemp(), work_path(spark, "pair")
    for i, some in enumerate((LINES[:2], LINES[2:])):
        land(src, f"{i}.txt", some)
        s = lines_stream(spark, src)
        (raw, counts), queries = jobs.start_pair(jobs.raw_messages(s), jobs.running_word_count(s), spark, "pair", out=out)
        for q in queries:
            q.awaitTermination()
    assert raw == out + "/raw" and spark.read.parquet(raw).count() == len(LINES)
    assert content(spark.read.parquet(counts)) == expected(LINES)


def test_jobs_over_any_stream(spark):
    from quarry.streaming import apps
    src = tempfile.mkdtemp()
    land(src, "a.txt", LINES)
    stream = lines_stream(spark, src)
    both, q = apps.rows_and_counts_job(spark, stream, work_path(spark, "o"), work_path(spark, "c"), "availableNow")
    q.awaitTermination()
    assert sorted(r.message for r in both.read_rows(spark).collect()) == sorted(LINES)
    assert content(both.read_totals(spark)) == expected(LINES)
    t, q = apps.running_word_changes_job(spark, stream, work_path(spark, "o"), work_path(spark, "c"), "availableNow")
    q.awaitTermination()
    assert content(t.read(spark)) == expected(LINES)
