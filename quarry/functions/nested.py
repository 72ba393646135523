"""Nested-structure helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_struct(df: DataFrame, struct_col: str, keep: list[str] | None = None,
                   sep: str | None = None) -> DataFrame:
    """Expand a (possibly nested) struct column into flat columns.

    Leaf fields become top-level columns named after the leaf (``sep=None``)
    or by their dotted path joined with ``sep``. Two columns of one name are
    an error (give ``sep`` to tell them apart by their paths).
    """
    dtype = df.schema[struct_col].dataType
    cols: list[Column] = [F.col(k) for k in (keep or [])]

    def walk(t: T.StructType, path: list[str]):
        for f in t.fields:
            p = path + [f.name]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, p)
            else:
                name = f.name if sep is None else sep.join(p[1:])
                cols.append(F.col(".".join(f"`{x}`" for x in p)).alias(name))

    walk(dtype, [struct_col])
    out = df.select(*cols)
    seen = [c.lower() for c in out.columns]
    twice = sorted({c for c in seen if seen.count(c) > 1})
    if twice:
        raise ValueError(f"flattening gives several columns named {', '.join(twice)}: pass sep")
    return out
