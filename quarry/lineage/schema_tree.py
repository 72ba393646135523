"""L1: fields of Avro schema documents, walked down as VARIANT values.

A document's tree is descended level by level, all documents at once. First
the named types it defines are found, wherever they stand; then the fields
are followed from the root through unions, named types and records. A row is
a field not yet resolved, with the piece of the document that describes it;
resolving it gives a leaf or the record's fields. Several levels are one
plan; what they leave is written to the shared folder and goes on from there,
so documents may be of any depth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import work_path

#: Levels descended between two written tables.
LEVELS = 3


def _get(v: str, path: str, kind: str = "variant") -> str:
    return f"try_variant_get({v}, '{path}', '{kind}')"


def _wraps(v: str) -> str:
    """Whether ``{"type": ...}`` holds an object or an array."""
    return f"({_get(v, '$.type.type')} IS NOT NULL OR {_get(v, '$.type[0]')} IS NOT NULL)"


def _array(v: str) -> str:
    return f"({_get(v, '$[0]')} IS NOT NULL)"


def _object(v: str) -> str:
    return f"({_get(v, '$.type')} IS NOT NULL)"


def _unwrapped(v: str) -> str:
    return f"CASE WHEN {_wraps(v)} THEN {_get(v, '$.type')} ELSE {v} END"


#: Of a named type ``v`` read in namespace ``space``: the namespace that names
#: inside it are read in, and its own full name there.
_NAME = _get("v", "$.name", "string")
_OWN = f"coalesce(nullif(regexp_extract({_NAME}, '^(.*)[.][^.]*$', 1), ''), {_get('v', '$.namespace', 'string')}, space)"
_FULL = "CASE WHEN contains(named, '.') OR own = '' THEN named ELSE concat_ws('.', own, named) END"


def _repeated(rows: DataFrame, step: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``step`` until every row is done; a step passes done rows on."""
    while True:
        for _ in range(LEVELS):
            rows = step(rows)
        path = work_path(rows.sparkSession, name)
        rows.write.parquet(path)
        rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
        if rows.filter("NOT done").isEmpty():
            return rows


def definitions(docs: DataFrame) -> DataFrame:
    """(doc, types): the named types of (doc, t) documents that have any, as
    a map from full name to definition and namespace. The first of one name
    counts. A map is no larger than its document."""
    def child(v: str, place: str) -> str:
        return f"named_struct('done', false, 'full', cast(null as string), 'v', {v}, 'space', own, 'at', concat(at, {place}))"

    none = "cast(array() as array<struct<done:boolean,full:string,v:variant,space:string,at:array<int>>>)"

    def one(path: str, place: int) -> str:
        inner = _get("v", path)
        return f"CASE WHEN {_object(inner)} OR {_array(inner)} THEN array({child(inner, f'array({place}, 0)')}) ELSE {none} END"

    def many(path: str, of: str, place: int) -> str:
        return (f"coalesce(filter(transform({_get('v', path, 'array<variant>')}, (x, i) -> {child(of, f'array({place}, i)')}), "
                f"c -> {_object('c.v')} OR {_array('c.v')}), {none})")

    def step(rows: DataFrame) -> DataFrame:
        named = f"CASE WHEN {_get('v', '$.type', 'string')} IN ('record', 'error', 'enum', 'fixed') THEN {_NAME} END"
        return (rows.selectExpr("*", f"CASE WHEN NOT done THEN {named} END AS named")
                .selectExpr("*", f"CASE WHEN named IS NULL THEN space ELSE {_OWN} END AS own")
                .selectExpr("doc", f"""inline(CASE WHEN done THEN array(named_struct('done', done, 'full', full, 'v', v, 'space', space, 'at', at))
                    ELSE concat(
                      CASE WHEN named IS NULL THEN {none}
                           ELSE array(named_struct('done', true, 'full', {_FULL}, 'v', v, 'space', own, 'at', at)) END,
                      {one('$.type', 0)}, {one('$.items', 1)}, {one('$.values', 2)},
                      {many('$.fields', _get('x', '$.type'), 3)}, {many('$', 'x', 4)}) END)"""))

    start = docs.selectExpr("doc", "false AS done", "cast(null as string) AS full", "t AS v", "'' AS space",
                            "cast(array() as array<int>) AS at")
    found = _repeated(start, step, "schema-types")
    return (found.groupBy("doc", "full").agg({"at": "min"}).withColumnRenamed("min(at)", "at").join(found, ["doc", "full", "at"])
            .selectExpr("doc", "named_struct('full', full, 'of', named_struct('v', v, 'space', space)) AS entry")
            .groupBy("doc").agg({"entry": "collect_list"})
            .selectExpr("doc AS _of", "map_from_entries(`collect_list(entry)`) AS types"))


def leaves(docs: DataFrame, types: DataFrame) -> DataFrame:
    """(doc, name, type, description) of the leaf fields of (doc, t)."""
    columns = ["done", "root", "name", "type", "description", "v", "space", "inside"]

    def state(**values: str) -> str:
        return "named_struct(" + ", ".join(f"'{c}', {values.get(c, c)}" for c in columns) + ")"

    # the first branch that is not null
    branch = (f"get(filter({_get('v', '$', 'array<variant>')}, "
              f"b -> coalesce({_get('b', '$', 'string')} <> 'null', true)), 0)")
    field = state(done="false", root="false", name=f"concat_ws('.', nullif(name, ''), {_get('f', '$.name', 'string')})",
                  type="cast(null as string)", description=f"coalesce({_get('f', '$.doc', 'string')}, '')",
                  v=_get("f", "$.type"), space="own", inside="concat(inside, array(full))")
    leaf = state(done="true", name="CASE WHEN root THEN 'value' ELSE name END",
                 type=f"CASE WHEN union THEN 'union' ELSE coalesce(kind, {_get('v', '$', 'string')}) END",
                 description="CASE WHEN NOT root THEN description END", v="parse_json('null')", space="''",
                 inside="cast(array() as array<string>)")

    def step(rows: DataFrame) -> DataFrame:
        for _ in range(2):
            rows = rows.withColumns({"v": F.expr(f"CASE WHEN done THEN v ELSE {_unwrapped('v')} END")})
        rows = rows.withColumns({"v": F.expr(f"CASE WHEN NOT done AND NOT root AND {_array('v')} THEN coalesce({branch}, v) ELSE v END")})
        rows = rows.withColumns({"v": F.expr(f"CASE WHEN done THEN v ELSE {_unwrapped('v')} END")})
        rows = rows.selectExpr("*", f"CASE WHEN NOT done AND NOT {_object('v')} AND NOT {_array('v')} THEN {_get('v', '$', 'string')} END AS word")
        rows = rows.selectExpr("*", "CASE WHEN contains(word, '.') OR space = '' THEN word ELSE concat_ws('.', space, word) END AS ref")
        rows = (rows.join(types, F.expr("doc = _of AND word IS NOT NULL"), "left")
                .selectExpr("doc", *columns, "coalesce(types[ref], types[word]) AS found")
                .selectExpr("doc", *[{"v": "coalesce(found.v, v) AS v", "space": "coalesce(found.space, space) AS space"}.get(c, c)
                                     for c in columns]))
        rows = rows.selectExpr("*", f"CASE WHEN NOT {_wraps('v')} THEN {_get('v', '$.type', 'string')} END AS kind", f"{_NAME} AS named",
                               f"({_array('v')} OR coalesce({_get('v', '$', 'string')} = '[]', false)) AS union")
        rows = rows.selectExpr("*", f"CASE WHEN named IS NULL THEN space ELSE {_OWN} END AS own")
        rows = rows.selectExpr("*", f"coalesce({_FULL}, '') AS full")
        return rows.selectExpr("doc", f"""inline(CASE
            WHEN done THEN array({state()})
            WHEN {_wraps('v')} OR (union AND NOT root AND {branch} IS NOT NULL) THEN array({state()})
            WHEN kind IN ('record', 'error') AND (full = '' OR NOT array_contains(inside, full))
              THEN transform({_get('v', '$.fields', 'array<variant>')}, f -> {field})
            ELSE array({leaf}) END)""")

    start = docs.selectExpr("doc", "false AS done", "true AS root", "'' AS name", "cast(null as string) AS type",
                            "cast(null as string) AS description", "t AS v", "'' AS space", "cast(array() as array<string>) AS inside")
    return _repeated(start, step, "schema-fields").select("doc", "name", "type", "description")


def document_fields(documents: DataFrame) -> DataFrame:
    """(doc, name, type, description) for (doc, schema) documents, ``doc`` a
    unique key. A schema without JSON punctuation is a type's bare name; a
    null one has no fields."""
    docs = (documents.filter("schema IS NOT NULL")
            .selectExpr("doc", r"regexp_replace(schema, '^\\s+|\\s+$', '') AS text")
            .selectExpr("doc", """parse_json(CASE WHEN left(text, 1) IN ('{', '[', '"') THEN text ELSE concat('"', text, '"') END) AS t"""))
    return leaves(docs, definitions(docs))
