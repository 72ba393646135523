import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.schemas import MOVIE, RATING
from quarry.sources import (
    kafka_options, parse_records, parse_vectors, read_delimited, read_events, read_libsvm,
    read_lines, rejected_records, write_result,
)


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_delimited_and_parse(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "movies.txt")
    _write(p, "1@Toy Story (1995)@Animation|Comedy\n2@(500) Days (2009)@Drama\n")
    df = read_delimited(spark, p, ["movieId", "title", "genres"], sep="@", schema=MOVIE)
    assert df.columns == ["movieId", "title", "genres"]
    assert df.filter(F.col("movieId") == 2).first().title == "(500) Days (2009)"
    inferred = read_delimited(spark, p, ["movieId", "title", "genres"], sep="@")
    assert dict(inferred.dtypes)["movieId"] == "int"
    lines = read_lines(spark, p)
    parsed = parse_records(lines, MOVIE, sep="@")
    assert parsed.count() == 2 and parsed.schema == MOVIE


def test_parse_records_modes(spark):
    lines = spark.createDataFrame([("1::10::4.5::100",), ("2::x::3.0::5",), ("bad",)], "value string")
    ok = parse_records(lines, RATING, sep="::", mode="permissive")
    assert [tuple(r) for r in ok.collect()] == [(1, 10, 4.5, 100)]
    with pytest.raises(Exception):
        parse_records(lines, RATING, sep="::", mode="failfast").collect()
    bad_number = spark.createDataFrame([("1::x::4.5::100",)], "value string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="bad movieId"):
            parse_records(bad_number, RATING, sep="::", mode="failfast").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert sorted(r.value for r in rejected_records(lines, RATING, sep="::").collect()) == ["2::x::3.0::5", "bad"]
    good = parse_records(spark.createDataFrame([("1::10::4.5::100",)], "value string"), RATING, sep="::", mode="failfast")
    assert [tuple(r) for r in good.collect()] == [(1, 10, 4.5, 100)] and good.schema == RATING


def test_parse_vectors_and_libsvm(spark):
    lines = spark.createDataFrame([("0.0 0.0 0.0",), ("9.0 9.1 9.2",)], "value string")
    v = parse_vectors(lines).collect()
    assert list(v[1].features) == [9.0, 9.1, 9.2]
    d = tempfile.mkdtemp()
    p = os.path.join(d, "sample.libsvm")
    _write(p, "1 1:0.5 3:1.5\n0 2:2.0\n")
    df = read_libsvm(spark, p, num_features=3)
    rows = df.orderBy("label").collect()
    assert rows[0].label == 0.0 and rows[1].features.toArray().tolist() == [0.5, 0.0, 1.5]


def test_read_events_json(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "ev.json")
    _write(p, json.dumps({"eventType": "START", "inputs": [{"namespace": "kafka", "name": "t",
            "facets": {"schema": {"fields": [{"name": "id", "type": "long", "description": ""}]}}}]}) + "\n")
    from quarry.lineage import lineage_fields
    rows = lineage_fields(read_events(spark, p)).collect()
    assert [(r.dataset, r.name, r.type) for r in rows] == [("t", "id", "long")]


def test_write_result_overwrites(spark):
    d = os.path.join(tempfile.mkdtemp(), "out")
    df = spark.range(10)
    write_result(df, d, num_files=1)
    write_result(df.limit(3), d, num_files=1)
    assert spark.read.parquet(d).count() == 3
    assert len([f for f in os.listdir(d) if f.endswith(".parquet")]) == 1
    t = os.path.join(tempfile.mkdtemp(), "pairs")
    write_result(spark.createDataFrame([("a", 2), ("b", 1)], "w string, n int"), t, fmt="tuples", num_files=1)
    assert sorted(r.value for r in spark.read.text(t).collect()) == ["(a,2)", "(b,1)"]


def test_kafka_options_use_prefixed_group():
    o = kafka_options("h:9092", "topic", "g1", "earliest")
    assert o["kafka.group.id"] == "g1" and "group.id" not in o
    assert o["startingOffsets"] == "earliest" and o["subscribe"] == "topic"


def test_number_range(spark):
    from quarry.sources import number_range
    assert number_range(spark, 100).count() == 100


def test_missing_connectors_fail_clearly(spark):
    from quarry.functions.binary import decode_payload
    from quarry.sources import kafka_stream
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "localhost:9092", "topic", "group")
    df = spark.createDataFrame([(bytearray(b"\x02a"),)], "value binary")
    with pytest.raises(Exception, match="(?i)avro"):
        df.select(decode_payload("value", '{"type": "string"}', codec="avro")).collect()
    with pytest.raises(ValueError):
        decode_payload("value", "k int", codec="xml")


HOSTILE = [None, "", " pad ", "a@b", 'quo"te', '"', "line\nbreak", "cr\r", "\\", "\\N", "\\N x", "tab\t", "plain", ",", "'"]


def test_csv_gives_every_string_back(spark):
    path = os.path.join(tempfile.mkdtemp(), "csv")
    df = spark.createDataFrame([(i, t, "end") for i, t in enumerate(HOSTILE)], "i int, t string, e string")
    for sep in ("@", ",", "|"):
        write_result(df, path, fmt="csv", sep=sep)
        back = read_delimited(spark, path, ["i", "t", "e"], sep=sep, schema=df.schema, exact=True)
        got = {r.i: r.t for r in back.collect()}
        assert got == dict(enumerate(HOSTILE)), (sep, got)


def test_read_delimited_fails_on_bad_records(spark):
    path = os.path.join(tempfile.mkdtemp(), "bad.txt")
    _write(path, "1@one@x\ntwo@2@y\n")
    with pytest.raises(Exception):
        read_delimited(spark, path, ["a", "b", "c"], schema=MOVIE).collect()
    rows = read_delimited(spark, path, ["a", "b", "c"], schema=MOVIE, mode="PERMISSIVE").collect()
    assert [r.a for r in rows] == [1, None]


def test_a_failed_write_keeps_the_old_result(spark):
    path = os.path.join(tempfile.mkdtemp(), "kept")
    write_result(spark.range(10), path)
    with pytest.raises(Exception):
        write_result(spark.range(10).selectExpr("raise_error('no') as id"), path)
    assert spark.read.parquet(path).count() == 10
