"""Rows of a vector table that can be worked on, and their batches in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries are below this, so their multiples by up to 256 are longs.
MAX_ENTRY = 2.0 ** 54
#: Rows worked on together in a task.
SLICE_ROWS = 4096


def fit_rows(table: DataFrame, vector: str = "embedding", id: str = "vec_id", label: str | None = None) -> DataFrame:
    """(vec_id, vector[, label]) of the rows whose vector can be worked on.

    Left out are null and empty vectors and those with a null, non-finite or
    huge entry (2**54 and more, whose multiples are no longs). Entries become
    doubles, ids longs (a null id stays)."""
    v = table[f"`{vector}`"].cast("array<double>")
    rows = table.select(table[f"`{id}`"].cast("long").alias("vec_id"), v.alias("vector"),
                        *([table[f"`{label}`"].alias("label")] if label else []))
    fit = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(MAX_ENTRY)))
    return rows.filter(F.coalesce(fit & (F.size("vector") > 0), F.lit(False)))


def of_one_length(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """(rows, dimension, number): the rows of the most frequent length, the
    greater one of a tie; vectors of another length have no place beside
    them. Nothing at all has dimension 0."""
    found = (rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.max(F.struct("n", "d")).alias("most")).first()["most"])
    if found is None:
        return rows.limit(0), 0, 0
    return rows.filter(F.size("vector") == found["d"]), found["d"], found["n"]


def slices(batch: pa.RecordBatch, dim: int, rows: int = SLICE_ROWS) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, doubles of shape (to - from, dim)) of a batch's vectors."""
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    for at in range(0, len(values), rows):
        yield at, min(at + rows, len(values)), values[at:at + rows]
