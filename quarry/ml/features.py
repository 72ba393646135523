"""Feature columns for Spark ML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_vector(c) -> Column:
    """An ``array<float|double>`` column as an ML dense vector."""
    from pyspark.ml.functions import array_to_vector
    c = F.col(c) if isinstance(c, str) else c
    return array_to_vector(c.cast("array<double>"))
