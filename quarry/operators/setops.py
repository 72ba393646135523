"""Set operations (U1-U4) with both duplicate semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both inputs, duplicates kept (no shuffle)."""
    return a.unionByName(b)


def _same(a: DataFrame, b: DataFrame):
    cond = None
    for c in a.columns:
        e = a[c].eqNullSafe(b[c])
        cond = e if cond is None else (cond & e)
    return cond


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows present in both, nulls equal. Both sides are
    de-duplicated before they meet: one row per distinct value is shuffled,
    however often it occurs."""
    a, b = a.distinct(), b.distinct()
    return a.join(b, _same(a, b), "left_semi")


def subtract_keep_dups(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` whose value never occurs in ``b``; ``a``'s
    duplicates survive (RDD ``subtract``). Unlike ``EXCEPT ALL`` a value
    present in ``b`` removes all its copies. Nulls compare equal.

    ``b`` is de-duplicated first (partial aggregate), so the anti join
    shuffles one row per distinct value of ``b``.
    """
    b = b.distinct()
    return a.join(b, _same(a, b), "left_anti")


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: distinct rows of ``a`` not in ``b`` (SQL ``EXCEPT``), both sides
    de-duplicated first."""
    a, b = a.distinct(), b.distinct()
    return a.join(b, _same(a, b), "left_anti")
