"""L1 schema flattening, L3 latest version, L4 facet document, L5 lineage
event flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.lineage.schema_tree import document_fields


def latest_per_key(df: DataFrame, key, order: list[str], values: list[str]) -> DataFrame:
    """L3 core: per key, the row with the greatest ``order`` tuple.

    ``max_by`` over a struct is a partial aggregate, so a hot key is reduced
    on the map side instead of being sorted in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def latest_schema(catalog: DataFrame, subjects: DataFrame | None = None,
                  subject: str = "subject", version: str = "schemaVersion") -> DataFrame:
    """L3: latest version of each subject's schema. With ``subjects`` given,
    every requested subject is returned; one without a schema gets nulls
    (not an error)."""
    cols = [c for c in catalog.columns if c != subject]
    latest = latest_per_key(catalog, subject, [version], cols)
    if subjects is None:
        return latest
    return subjects.select(subject).join(latest, subject, "left")


def schema_facet(catalog: DataFrame, registry_url: str, subject: str = "subject") -> DataFrame:
    """L4: one JSON schema-facet document per catalogue row."""
    doc = F.to_json(F.struct(
        F.lit(registry_url).alias("schemaRegistryUrl"), F.col(subject).alias("subject"),
        F.col("schemaId"), F.col("schemaVersion"), F.col("schemaType"), F.col("schema")))
    return catalog.select(subject, "schemaVersion", doc.alias("facet"))


def schema_fields(catalog: DataFrame, schema_col: str = "schema",
                  keys: tuple[str, ...] = ("subject", "schemaVersion")) -> DataFrame:
    """L1: flatten Avro schema documents to ``(keys..., name, type, description)``.

    A row for each leaf field, under its dotted name. A field's union stands
    for its first branch that is not null; records are descended into to any
    depth, whether written in place or named elsewhere in the document;
    arrays, maps, enums, fixed and primitive types are leaves, and so is a
    record inside itself. A root that is no record is one row ``value``
    without description; other descriptions default to ``""``. A null
    document has no fields, one that is no JSON is an error. Equal documents
    are worked out once (see :mod:`quarry.lineage.schema_tree`).
    """
    rows = catalog.select(*keys, F.sha2(F.col(schema_col), 256).alias("_doc"))
    documents = catalog.select(F.sha2(F.col(schema_col), 256).alias("doc"), F.col(schema_col).alias("schema")).distinct()
    found = document_fields(documents)
    return rows.join(found, F.col("_doc") == F.col("doc")).select(*keys, "name", "type", "description")


def lineage_fields(events: DataFrame) -> DataFrame:
    """Schema fields of every input dataset of lineage run events."""
    inp = events.select(F.explode("inputs").alias("i"))
    return inp.select(
        F.col("i.namespace").alias("namespace"), F.col("i.name").alias("dataset"),
        F.explode("i.facets.schema.fields").alias("f")).select(
        "namespace", "dataset", F.col("f.name").alias("name"), F.col("f.type").alias("type"),
        F.col("f.description").alias("description"))
