"""Binary payload helpers: header strip, text cast, schema decode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_header(c, header_bytes: int = 5) -> Column:
    """Drop a fixed-size wire header (magic byte + 4-byte schema id)."""
    return F.substring(_c(c), header_bytes + 1, 2**31 - 1)


def to_text(c) -> Column:
    """Cast a binary payload to a UTF-8 string."""
    return _c(c).cast("string")


def decode_payload(c, schema: T.StructType | str, codec: str = "json",
                   options: dict | None = None) -> Column:
    """Decode a payload column into a struct with a fixed schema.

    ``codec="json"`` uses ``from_json``; ``codec="avro"`` uses Spark's
    ``from_avro`` and needs the spark-avro package on the classpath.
    """
    if codec == "json":
        src = _c(c)
        return F.from_json(src.cast("string"), schema, options or {})
    if codec == "avro":
        try:
            from pyspark.sql.avro.functions import from_avro
        except ImportError as e:  # pragma: no cover
            raise RuntimeError("Avro decoding needs pyspark.sql.avro") from e
        if not isinstance(schema, str):
            raise TypeError("Avro decoding takes the Avro schema as a JSON string")
        return from_avro(_c(c), schema, options or {})
    raise ValueError(f"unknown codec {codec!r}")
