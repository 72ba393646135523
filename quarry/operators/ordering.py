"""Sort, limit and top-k (O1-O8). ``orderBy(..).limit(n)`` becomes
``TakeOrderedAndProject``: each task keeps its n best rows, the driver-side
merge sees n rows per task, never the whole input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(by, ascending) -> list[Column]:
    by = [by] if isinstance(by, (str, Column)) else list(by)
    asc = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    out = []
    for b, a in zip(by, asc):
        c = F.col(b) if isinstance(b, str) else b
        out.append(c.asc_nulls_first() if a else c.desc_nulls_last())
    return out


def sort_by(df: DataFrame, by, ascending=True, tie_break=None) -> DataFrame:
    """O1 / O2: total order; ``tie_break`` columns (ascending) make ties
    deterministic.

    A global sort range-partitions on its keys; a value shared by a large
    share of the rows would fall into one range. Unique ``tie_break``
    columns let the range partitioner cut such a value into several
    partitions."""
    order = _order(by, ascending)
    if tie_break:
        order += _order(tie_break, True)
    return df.orderBy(*order)


def top_n(df: DataFrame, n: int, by, ascending=False, tie_break=None) -> DataFrame:
    """First ``n`` rows in the given order (largest by default)."""
    return sort_by(df, by, ascending, tie_break).limit(n)


def first_row(df: DataFrame, by, tie_break=None) -> DataFrame:
    """The first row in a given order."""
    return top_n(df, 1, by, True, tie_break)
