"""Payloads decoded under the schema they were written with.

A framed message begins with a zero byte and the four-byte id of its schema.
The catalogue tells which schemas these ids name, and one pass decodes every
message with its own: a branch for each live version, whose results meet in a
type that has the fields of all of them. What can't be decoded goes to a
reject table with the reason and the bytes as they came, and can be decoded
later, when its schema is known.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.binary import strip_header
from quarry.functions.nested import flatten_struct
from quarry.sources import folders
from quarry.streaming.jobs import output_places, trigger_kwargs

HEADER_BYTES = 5
#: Live versions that one decoding pass has branches for.
MOST_VERSIONS = 200
_CORRUPT = "_unreadable"
_PRIMITIVE = {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(),
              "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(),
              "enum": T.StringType(), "fixed": T.BinaryType()}
_WIDER = ["int", "bigint", "float", "double"]


def frame(payload: Column, schema_id: Column) -> Column:
    """A message on the wire: zero byte, big-endian schema id, payload."""
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(schema_id.cast("long")), 8, "0")), payload)


def schema_id(value: Column) -> Column:
    """The id in a message's header; null without a whole header."""
    whole = (F.octet_length(value) >= HEADER_BYTES) & (F.substring(value, 1, 1) == F.unhex(F.lit("00")))
    return F.when(whole, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def spark_type(document: str) -> T.DataType:
    """The type of an Avro document: a union is its first branch that is not
    null, named types may be referred to by name, logical types are their
    underlying ones. A record inside itself has no such type (an error)."""
    named: dict[str, object] = {}

    def of(t, space: str, inside: tuple[str, ...]) -> T.DataType:
        if isinstance(t, list):
            return of(next((x for x in t if x != "null"), "null"), space, inside)
        if isinstance(t, str):
            full = t if "." in t or t in _PRIMITIVE else f"{space}.{t}" if space else t
            if full in named or t in named:
                found, own = named.get(full) or named[t]
                return of(found, own, inside)
            if t not in _PRIMITIVE:
                raise ValueError(f"unknown type {t}")
            return _PRIMITIVE[t]
        kind = t["type"]
        if kind == "array":
            return T.ArrayType(of(t["items"], space, inside))
        if kind == "map":
            return T.MapType(T.StringType(), of(t["values"], space, inside))
        if kind in ("record", "error", "enum", "fixed"):
            name = t["name"]
            own = name.rpartition(".")[0] or t.get("namespace", space)
            full = name if "." in name else f"{own}.{name}" if own else name
            if full in inside:
                raise ValueError(f"record {full} holds itself")
            named.setdefault(full, (t, own))
            if kind in _PRIMITIVE:
                return _PRIMITIVE[kind]
            return T.StructType([T.StructField(f["name"], of(f["type"], own, (*inside, full))) for f in t["fields"]])
        return of(kind, space, inside)

    text = document.strip()
    return of(json.loads(text) if text[:1] in ("{", "[", '"') else text, "", ())


@dataclass(frozen=True)
class Writer:
    """One live schema version."""
    schema_id: int
    version: int
    document: str
    kind: T.StructType


def live_writers(catalog: DataFrame, subjects: list[str] | None = None, most: int = MOST_VERSIONS) -> list[Writer]:
    """The catalogue's versions of the subjects (all by default), each id
    once, by id. Their number is checked: a table of more than ``most`` can't
    be decoded in one pass and is an error."""
    rows = catalog.select("schemaId", "schemaVersion", "schema").dropna()
    if subjects is not None:
        rows = rows.join(catalog.filter(F.col("subject").isin(subjects)).select("schemaId").distinct(), "schemaId", "left_semi")
    found = rows.groupBy("schemaId").agg(F.max_by(F.struct("schemaVersion", "schema"), "schemaVersion").alias("s")).select(
        "schemaId", "s.*").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} live schemas: name the subjects")
    out = []
    for r in sorted(found, key=lambda r: r["schemaId"]):
        kind = spark_type(r["schema"])
        if not isinstance(kind, T.StructType):
            kind = T.StructType([T.StructField("value", kind)])
        out.append(Writer(int(r["schemaId"]), int(r["schemaVersion"]), r["schema"], kind))
    return out


def merged_type(a: T.DataType, b: T.DataType, where: str = "message") -> T.DataType:
    """The type that holds values of both: fields by name, in order of first
    appearance, numbers widened. Others that differ are an error."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        mine = {f.name for f in a.fields}
        return T.StructType([
            *[T.StructField(f.name, merged_type(f.dataType, other[f.name], f"{where}.{f.name}") if f.name in other else f.dataType)
              for f in a.fields], *[f for f in b.fields if f.name not in mine]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType, where))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(T.StringType(), merged_type(a.valueType, b.valueType, where))
    names = [x.simpleString() for x in (a, b)]
    if all(n in _WIDER for n in names):
        # a long in a float loses digits, in a double fewer
        return a if names[0] == max(names, key=_WIDER.index) and names[0] != "float" else (
            b if names[1] == max(names, key=_WIDER.index) and names[1] != "float" else T.DoubleType())
    if set(names) == {"string", "binary"}:
        return T.BinaryType()
    raise ValueError(f"{where} is {names[0]} in one version and {names[1]} in another")


def union_type(writers: list[Writer]) -> T.StructType:
    """Fields of all versions by name, the oldest version's first."""
    out: T.DataType = T.StructType([])
    for w in sorted(writers, key=lambda w: (w.version, w.schema_id)):
        out = merged_type(out, w.kind)
    return out


def as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one version in the type of all; what it lacks is null."""
    if have == want:
        return c
    if isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        return F.when(c.isNotNull(), F.struct(*[
            (as_type(c.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields]))
    if isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.transform_values(c, lambda _, v: as_type(v, have.valueType, want.valueType))
    return c.cast(want)


def _plain(t):
    """An Avro document without logical types."""
    if isinstance(t, dict):
        return {k: _plain(v) for k, v in t.items() if k != "logicalType"}
    return [_plain(x) for x in t] if isinstance(t, list) else t


def _decoded(payload: Column, writer: Writer, codec: str) -> Column:
    if codec == "json":
        kind = T.StructType([*writer.kind.fields, T.StructField(_CORRUPT, T.StringType())])
        return F.from_json(payload.cast("string"), kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    if codec == "avro":  # needs the spark-avro package
        from pyspark.sql.avro.functions import from_avro
        return from_avro(payload, json.dumps(_plain(json.loads(writer.document))), {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown codec {codec!r}")


def decode_by_writer(df: DataFrame, writers: list[Writer], value: str = "value", keep: list[str] | None = None,
                     codec: str = "json") -> DataFrame:
    """``keep``, ``value``, schema_id, schema_version, message and reject.

    ``message`` has the fields of all versions, null where the message's own
    version lacks them. ``reject`` is null for decoded messages, else why
    there is none: ``no payload`` (null), ``no header`` (under five bytes, or
    another first byte), ``unknown schema id`` or ``malformed payload``.
    """
    keep = list(keep or [])
    kind = union_type(writers)
    raw, sid = F.col(f"`{value}`").cast("binary"), F.col("schema_id")
    # a column for each version, so that a payload is read once
    read = df.select(*[F.col(f"`{k}`") for k in keep], raw.alias("value"), schema_id(raw).alias("schema_id")).select(
        "*", *[F.when(sid == w.schema_id, _decoded(strip_header("value", HEADER_BYTES), w, codec)).alias(f"_v{i}")
               for i, w in enumerate(writers)])

    def unreadable(i: int) -> Column:
        c = F.col(f"_v{i}")
        return c.isNull() | c.getField(_CORRUPT).isNotNull() if codec == "json" else c.isNull()

    known = sid.isin([w.schema_id for w in writers]) if writers else F.lit(False)
    broken, message, version = F.lit(False), F.lit(None).cast(kind), F.lit(None).cast("int")
    for i, w in enumerate(writers):
        own = sid == w.schema_id
        broken = F.when(own, unreadable(i)).otherwise(broken)
        message = F.when(own & ~unreadable(i), as_type(F.struct(*[F.col(f"_v{i}").getField(f.name).alias(f.name) for f in w.kind.fields]),
                                                      w.kind, kind)).otherwise(message)
        version = F.when(own, F.lit(w.version)).otherwise(version)
    reject = (F.when(F.col("value").isNull(), "no payload").when(sid.isNull(), "no header")
              .when(~known, "unknown schema id").when(broken, "malformed payload"))
    return read.select(*[F.col(f"`{k}`") for k in keep], "value", "schema_id", version.alias("schema_version"),
                       message.alias("message"), reject.alias("reject"))


def accepted(decoded: DataFrame, keep: list[str] | None = None, sep: str | None = None) -> DataFrame:
    """The decoded messages, flat: ``keep``, schema_version and the leaves."""
    return flatten_struct(decoded.filter(F.col("reject").isNull()), "message", keep=[*(keep or []), "schema_version"], sep=sep)


def rejected(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep``, value, schema_id and reject of what could not be decoded."""
    return decoded.filter(F.col("reject").isNotNull()).select(*(keep or []), "value", "schema_id", "reject")


def start_by_writer(spark: SparkSession, stream: DataFrame, name: str, catalog: Callable[[SparkSession], DataFrame],
                    subjects: list[str] | None = None, value: str = "value", keep: list[str] | None = None, codec: str = "json",
                    trigger: str | None = "availableNow", out: str | None = None, checkpoint: str | None = None):
    """Start decoding a stream of framed messages; (result folder, query).
    Each micro-batch asks the catalogue for the live versions, is decoded once
    and writes ``accepted/batch_id=n`` and ``rejects/batch_id=n``, which a
    replay replaces. Read them with :func:`read_accepted` and
    :func:`read_rejects`."""
    out, checkpoint = output_places(spark, name, out, checkpoint)

    def per_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        decoded = decode_by_writer(batch, live_writers(catalog(session), subjects), value, keep, codec).persist()
        try:
            rejected(decoded, keep).write.mode("overwrite").parquet(f"{out}/rejects/batch_id={number}")
            good = decoded.filter(F.col("reject").isNull()).select(*(keep or []), "schema_id", "schema_version", "message")
            good.write.mode("overwrite").parquet(f"{out}/accepted/batch_id={number}")
        finally:
            decoded.unpersist()

    query = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(per_batch)
             .trigger(**trigger_kwargs(trigger)).start())
    return out, query


def run_by_writer(spark: SparkSession, stream: DataFrame, name: str, catalog: Callable[[SparkSession], DataFrame],
                  subjects: list[str] | None = None, **options) -> str:
    """:func:`start_by_writer`, until the available input is consumed."""
    out, query = start_by_writer(spark, stream, name, catalog, subjects, **options)
    query.awaitTermination()
    return out


def _kept(keep: dict[str, str] | None) -> list[T.StructField]:
    return [T.StructField(k, T._parse_datatype_string(t)) for k, t in (keep or {}).items()]


def read_accepted(spark: SparkSession, out: str, writers: list[Writer], keep: dict[str, str] | None = None) -> DataFrame:
    """All accepted messages in the type of ``writers``: files written before
    a version was known read as having nulls, or narrower numbers."""
    folders.make(spark, f"{out}/accepted")
    schema = T.StructType([*_kept(keep), T.StructField("schema_id", T.LongType()), T.StructField("schema_version", T.IntegerType()),
                           T.StructField("message", union_type(writers))])
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{out}/accepted")


def read_rejects(spark: SparkSession, out: str, keep: dict[str, str] | None = None) -> DataFrame:
    """All rejects; :func:`decode_by_writer` takes them again when more
    schemas are known."""
    folders.make(spark, f"{out}/rejects")
    schema = T.StructType([*_kept(keep), T.StructField("value", T.BinaryType()), T.StructField("schema_id", T.LongType()),
                           T.StructField("reject", T.StringType())])
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{out}/rejects")
