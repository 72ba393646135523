import json

from pyspark.sql import types as T

from quarry.lineage import latest_schema, schema_facet, schema_fields
from quarry.lineage.documents import schema_field_rows
from quarry.schemas import PRODUCT_MESSAGE

def avro_of(schema, name):
    """The wire format of a message (fixed field names and types) as an Avro
    document, from the one definition in ``quarry.schemas``."""
    kinds = {"string": "string", "bigint": "long"}
    return {"type": "record", "name": name, "fields": [
        {"name": f.name, "type": ["null", avro_of(f.dataType, f.name) if isinstance(f.dataType, T.StructType)
                                  else kinds[f.dataType.simpleString()]]} for f in schema.fields]}


PRODUCT_SCHEMA = avro_of(PRODUCT_MESSAGE, "Message")

OTHER = {"type": "record", "name": "R", "fields": [
    {"name": "tags", "type": {"type": "array", "items": "string"}, "doc": "labels"},
    {"name": "rev", "type": ["long", "null"]},
    {"name": "size", "type": {"type": "record", "name": "Size", "fields": [
        {"name": "width", "type": "int"}, {"name": "unit", "type": {"type": "enum", "name": "Unit", "symbols": ["CM"]}}]}},
    {"name": "again", "type": ["null", "Size"]},
    {"name": "ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
]}


def _catalog(spark):
    rows = [("product-value", 1, 1, "AVRO", json.dumps(PRODUCT_SCHEMA)),
            ("other-value", 7, 1, "AVRO", json.dumps(OTHER)),
            ("other-value", 8, 2, "AVRO", json.dumps("string"))]
    return spark.createDataFrame(rows, "subject string, schemaId int, schemaVersion int, schemaType string, schema string")


def test_schema_fields_flattens_product(spark):
    out = schema_fields(_catalog(spark).filter("subject = 'product-value'"))
    got = sorted((r.name, r.type, r.description) for r in out.collect())
    assert got == sorted([
        ("creationDate", "string", ""), ("id", "long", ""), ("product.productName", "string", ""),
        ("product.color", "string", ""), ("product.material", "string", ""),
        ("product.price", "string", ""), ("product.promotionCode", "string", "")])


def test_schema_fields_leaves_and_root(spark):
    out = schema_fields(_catalog(spark).filter("subject = 'other-value'"))
    got = {(r.schemaVersion, r.name): (r.type, r.description) for r in out.collect()}
    assert got == {(1, "tags"): ("array", "labels"), (1, "rev"): ("long", ""),
                   (1, "size.width"): ("int", ""), (1, "size.unit"): ("enum", ""),
                   (1, "again.width"): ("int", ""), (1, "again.unit"): ("enum", ""), (1, "ts"): ("long", ""),
                   (2, "value"): ("string", None)}


def test_latest_schema_and_missing_subject(spark):
    cat = _catalog(spark)
    subjects = spark.createDataFrame([("other-value",), ("missing-value",)], "subject string")
    got = {r.subject: r.schemaVersion for r in latest_schema(cat, subjects).collect()}
    assert got == {"other-value": 2, "missing-value": None}
    facet = json.loads(schema_facet(cat.filter("schemaId = 8"), "http://registry:8081").first().facet)
    assert facet["subject"] == "other-value" and facet["schemaVersion"] == 2


def test_documents_of_any_depth():
    doc = {"type": "long"}
    for i in reversed(range(60)):
        doc = {"type": "record", "name": f"L{i}", "fields": [
            {"name": "x", "type": "int"}, {"name": "d", "type": ["null", doc], "doc": f"level {i}"}]}
    rows = schema_field_rows(json.dumps(doc))
    assert len(rows) == 61
    assert rows[0] == ("x", "int", "") and rows[-1] == (".".join(["d"] * 60), "long", "level 59")


def test_roots_names_and_unions():
    union = json.dumps(["null", {"type": "record", "name": "A", "fields": []}])
    assert schema_field_rows(union) == [("value", "union", None)]
    assert schema_field_rows('"string"') == [("value", "string", None)] and schema_field_rows(None) == []
    spaced = {"type": "record", "name": "a.b.Outer", "fields": [
        {"name": "p", "type": {"type": "record", "name": "In", "fields": [{"name": "x", "type": "int"}]}},
        {"name": "q", "type": "In"}, {"name": "r", "type": ["null", "a.b.In"]},
        {"name": "me", "type": ["null", "Outer"]}, {"name": "none", "type": ["null"]}]}
    assert [r[:2] for r in schema_field_rows(json.dumps(spaced))] == [
        ("p.x", "int"), ("q.x", "int"), ("r.x", "int"), ("me", "record"), ("none", "union")]


DEEP = {"type": "long"}
for _i in reversed(range(12)):
    DEEP = {"type": "record", "name": f"L{_i}", "fields": [
        {"name": "x", "type": "int"}, {"name": "d", "type": ["null", DEEP], "doc": f"level {_i}"}]}
LINKED = {"type": "record", "name": "Node", "namespace": "a.b", "fields": [
    {"name": "value", "type": "string"}, {"name": "next", "type": ["null", "Node"], "doc": "the rest"},
    {"name": "pair", "type": {"type": "record", "name": "Pair", "fields": [
        {"name": "left", "type": "a.b.Node"}, {"name": "right", "type": ["null", "Pair"]}, {"name": "n", "type": ["null"]}]}},
    {"name": "again", "type": "Pair"}, {"name": "wrapped", "type": {"type": {"type": {"type": "int", "logicalType": "date"}}}},
    {"name": "m", "type": {"type": "map", "values": "Pair"}}, {"name": "e", "type": {"type": "enum", "name": "c.E", "symbols": []}},
    {"name": "f", "type": ["null", "c.E"]}, {"name": "empty", "type": {"type": "record", "name": "Nothing", "fields": []}}]}


def fields_of(spark, documents):
    rows = [(f"s{i}", i, 1, "AVRO", d) for i, d in enumerate(documents)]
    cat = spark.createDataFrame(rows, "subject string, schemaId int, schemaVersion int, schemaType string, schema string")
    got = {f"s{i}": [] for i in range(len(documents))}
    for r in schema_fields(cat).collect():
        got[r.subject].append((r.name, r.type, r.description))
    return [sorted(got[f"s{i}"]) for i in range(len(documents))]


def test_walk_equals_one_document_at_a_time(spark):
    documents = [json.dumps(d) for d in (PRODUCT_SCHEMA, OTHER, DEEP, LINKED, ["null", "string"], [], {"type": "array", "items": OTHER},
                                         {"type": {"type": "string"}}, {"type": "fixed", "name": "F", "size": 4}, "long")]
    documents += ["  bytes \n", "\n " + json.dumps(OTHER, indent=2), None, json.dumps(OTHER)]
    assert fields_of(spark, documents) == [sorted(schema_field_rows(d)) for d in documents]


def test_records_named_in_arrays_and_later_are_followed(spark):
    doc = {"type": "record", "name": "R", "fields": [
        {"name": "list", "type": {"type": "array", "items": {"type": "record", "name": "Item", "fields": [{"name": "x", "type": "int"}]}}},
        {"name": "one", "type": ["null", "Item"]}, {"name": "later", "type": "Late"},
        {"name": "late", "type": {"type": "record", "name": "Late", "fields": [{"name": "y", "type": "long"}]}}]}
    assert fields_of(spark, [json.dumps(doc)]) == [[
        ("late.y", "long", ""), ("later.y", "long", ""), ("list", "array", ""), ("one.x", "int", "")]]


def test_schema_walk_runs_no_python(spark):
    plan = schema_fields(_catalog(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_catalogue_has_no_fields(spark):
    assert schema_fields(_catalog(spark).limit(0)).collect() == []
