"""Schema catalogue and lineage tables (L1-L5), computed as Spark jobs over
tables instead of driver-side registry clients."""

from quarry.lineage.catalog import (  # noqa: F401
    latest_per_key, latest_schema, lineage_fields, schema_facet, schema_fields,
)
