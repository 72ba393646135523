import json
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.lineage import writers as W
from quarry.session import work_path

CATALOG = "subject string, schemaId int, schemaVersion int, schemaType string, schema string"


def record(record_name, /, **fields):
    return {"type": "record", "name": record_name, "fields": [{"name": k, "type": t} for k, t in fields.items()]}


V1 = record("M", id="int", item=["null", record("Item", name="string", size="int")], tags={"type": "array", "items": "int"})
V2 = record("M", id=["null", "long"], item=["null", record("Item", size="double", colour=["null", "string"])],
            tags={"type": "array", "items": "long"}, extra={"type": "map", "values": "string"})


def catalog(spark, *rows):
    return spark.createDataFrame([(s, i, v, "AVRO", d if isinstance(d, str) else json.dumps(d)) for s, i, v, d in rows], CATALOG)


def framed(spark, rows):
    """(message_id, value) of (id, schema id, document or text)."""
    df = spark.createDataFrame([(m, i, p if isinstance(p, str) else json.dumps(p)) for m, i, p in rows], "m long, i long, p string")
    return df.select("m", W.frame(F.encode("p", "UTF-8"), F.col("i")).alias("value"))


def both(spark):
    return W.live_writers(catalog(spark, ("a", 1, 1, V1), ("a", 70000, 2, V2)))


def test_header(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 255, 256, 70000, 2 ** 31 - 1)], "i long")
    got = df.select("i", W.frame(F.encode(F.lit("xy"), "UTF-8"), F.col("i")).alias("v")).select(
        "i", W.schema_id(F.col("v")).alias("s"), F.octet_length("v").alias("n")).collect()
    assert all(r.i == r.s and r.n == 7 for r in got)
    odd = spark.createDataFrame([(bytearray(b""),), (bytearray(b"\0\0\0\1"),), (bytearray(b"\1\0\0\0\1"),), (None,)], "v binary")
    assert [r[0] for r in odd.select(W.schema_id(F.col("v"))).collect()] == [None] * 4


def test_every_message_under_its_own_version(spark):
    rows = [(1, 1, {"id": 3, "item": {"name": "n", "size": 4}, "tags": [1, 2]}),
            (2, 70000, {"id": 5_000_000_000, "item": {"size": 1.5, "colour": "red"}, "tags": [6_000_000_000], "extra": {"k": "v"}}),
            (3, 70000, {"id": None, "item": None, "tags": None})]
    got = {r.m: r for r in W.decode_by_writer(framed(spark, rows), both(spark), keep=["m"]).collect()}
    assert [got[m].schema_version for m in (1, 2, 3)] == [1, 2, 2] and all(r.reject is None for r in got.values())
    assert got[1].message.asDict(True) == {"id": 3, "item": {"name": "n", "size": 4.0, "colour": None}, "tags": [1, 2], "extra": None}
    assert got[2].message.asDict(True) == {"id": 5_000_000_000, "item": {"name": None, "size": 1.5, "colour": "red"},
                                           "tags": [6_000_000_000], "extra": {"k": "v"}}
    assert got[3].message.asDict(True) == {"id": None, "item": None, "tags": None, "extra": None}


def test_rejects_hold_the_bytes_and_the_reason(spark):
    good = framed(spark, [(1, 1, {"id": 1}), (2, 9, {"id": 1}), (3, 1, '{"id": '), (4, 1, '{"id": "no number"}'), (5, 1, "")])
    odd = spark.createDataFrame([(6, bytearray(b"abc")), (7, None), (8, bytearray(b"\1\0\0\0\1{}"))], "m long, value binary")
    decoded = W.decode_by_writer(good.unionByName(odd), both(spark), keep=["m"])
    bad = {r.m: r for r in W.rejected(decoded, ["m"]).collect()}
    assert {m: r.reject for m, r in bad.items()} == {
        2: "unknown schema id", 3: "malformed payload", 4: "malformed payload", 5: "malformed payload", 6: "no header",
        7: "no payload", 8: "no header"}
    assert bytes(bad[6].value) == b"abc" and bad[2].schema_id == 9
    assert [r.m for r in W.accepted(decoded.withColumn("message", F.struct("message.id")), ["m"]).collect()] == [1]


def test_live_versions(spark):
    cat = catalog(spark, ("a", 1, 1, V1), ("b", 2, 1, '"string"'), ("a", 3, 2, V2), ("c", 1, 1, V1), ("a", 4, 3, "long"))
    assert [(w.schema_id, w.version) for w in W.live_writers(cat)] == [(1, 1), (2, 1), (3, 2), (4, 3)]
    assert [w.schema_id for w in W.live_writers(cat, ["b"])] == [2]
    assert W.live_writers(cat, ["none"]) == []
    with pytest.raises(ValueError, match="more than 2"):
        W.live_writers(cat, most=2)
    none = W.decode_by_writer(framed(spark, [(1, 1, {})]), [], keep=["m"]).first()
    assert none.reject == "unknown schema id"


def test_types_of_documents():
    assert W.spark_type(json.dumps(["null", "int"])) == T.IntegerType() and W.spark_type("long") == T.LongType()
    doc = {"type": "record", "name": "x.R", "fields": [
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A"]}}, {"name": "f", "type": ["null", "x.E"]},
        {"name": "s", "type": {"type": "record", "name": "S", "fields": [{"name": "b", "type": "bytes"}]}}, {"name": "again", "type": "S"}]}
    assert W.spark_type(json.dumps(doc)).simpleString() == "struct<t:bigint,e:string,f:string,s:struct<b:binary>,again:struct<b:binary>>"
    with pytest.raises(ValueError, match="holds itself"):
        W.spark_type(json.dumps(record("R", next=["null", "R"])))
    with pytest.raises(ValueError, match="unknown type"):
        W.spark_type(json.dumps(record("R", a="Missing")))


@pytest.mark.parametrize("a, b, both_", [
    ("int", "long", "bigint"), ("long", "int", "bigint"), ("int", "float", "double"), ("float", "double", "double"),
    ("long", "double", "double"), ("string", "bytes", "binary"), ("null", "string", "string"), ("float", "float", "float")])
def test_widened_types(a, b, both_):
    assert W.merged_type(W.spark_type(a), W.spark_type(b)).simpleString() == both_


def test_types_that_differ_are_an_error():
    one, two = W.spark_type(json.dumps(record("R", a="int"))), W.spark_type(json.dumps(record("R", a="string")))
    with pytest.raises(ValueError, match="message.a is int in one version and string"):
        W.merged_type(one, two)


def test_stream_learns_a_version_between_batches(spark):
    src, out = tempfile.mkdtemp(), work_path(spark, "versions")
    known = [("a", 1, 1, V1)]
    rows = [(1, 1, {"id": 3}), (2, 70000, {"id": 4})]

    def run():
        framed(spark, rows).write.mode("append").parquet(src + "/in")
        stream = spark.readStream.schema("m long, value binary").parquet(src + "/in")
        return W.run_by_writer(spark, stream, "versions", lambda s: catalog(s, *known), keep=["m"], out=out)

    run()
    keep = {"m": "long"}
    assert [(r.m, r.reject) for r in W.read_rejects(spark, out, keep).collect()] == [(2, "unknown schema id")]
    known.append(("a", 70000, 2, V2))
    rows = [(3, 70000, {"id": 5, "extra": {"a": "b"}})]
    run()
    got = {r.m: r.message for r in W.read_accepted(spark, out, both(spark), keep).collect()}
    assert got[1].id == 3 and got[1].extra is None and got[3].extra == {"a": "b"} and len(got) == 2
    again = W.decode_by_writer(W.read_rejects(spark, out, keep), both(spark), keep=["m"]).collect()
    assert [(r.m, r.message.id, r.reject) for r in again] == [(2, 4, None)]
