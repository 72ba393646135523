"""Embedding whitening: centre, rotate to the covariance's eigenvectors, scale.

Entries are integers here, so sums and the covariance are exact: partial sums
of the tasks are added up by Spark as decimals, and only two tables as small
as the covariance reach the driver. Its eigenvectors come from spectral divide
and conquer (:mod:`quarry.llm.qdwh`) and go to the tasks that whiten.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import qdwh
from quarry.llm.vectors import fit_rows, of_one_length, slices

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: An eigenvalue up to this share of the largest is noise and no component.
LEAST_SHARE = 1e-12
_LIMB = 20
_SUM = "i int, j int, total decimal(38,0)"
_SUM_ARROW = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.decimal128(38, 0))])


def integers(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values).astype(np.int64) + OFFSET


def exact_gram(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of up to 4096 rows of integers, as Python integers. Products
    of 20-bit numbers add up exactly in doubles; larger ones are cut in limbs."""
    top = int(np.abs(y).max(initial=0))
    if top < 1 << _LIMB:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    if top < 1 << 2 * _LIMB:
        high = y >> _LIMB
        low = (y - (high << _LIMB)).astype(float)
        high = high.astype(float)
        cross = (high.T @ low).astype(np.int64).astype(object)
        return (((high.T @ high).astype(np.int64).astype(object) << 2 * _LIMB) + ((cross + cross.T) << _LIMB)
                + (low.T @ low).astype(np.int64).astype(object))
    big = np.abs(y).max(axis=1) >= 1 << 2 * _LIMB
    b = y[big].astype(object)
    return exact_gram(y[~big]) + b.T @ b


def _decimals(i: np.ndarray, j: np.ndarray, totals: list[int]) -> pa.RecordBatch:
    wide = decimal.Context(prec=38)
    return pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                            pa.array([wide.create_decimal(int(t)) for t in totals], pa.decimal128(38, 0))], schema=_SUM_ARROW)


def _totals(partial: DataFrame) -> dict[tuple[int, int], int]:
    """One row for each pair of dimensions, whatever the number of rows."""
    rows = partial.groupBy("i", "j").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()
    return {(r["i"], r["j"]): int(r["total"]) for r in rows}


def sums(rows: DataFrame, dim: int) -> list[int]:
    """Per-dimension sums of the integer vectors."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, object)
        for batch in batches:
            for _, _, v in slices(batch, dim):
                x = integers(v)
                high = x >> 32  # sums of 4096 halves are longs
                total = total + (high.sum(axis=0).astype(object) << 32) + (x - (high << 32)).sum(axis=0).astype(object)
        yield _decimals(np.arange(dim), np.zeros(dim), list(total))

    found = _totals(rows.select("vector").mapInArrow(partial, _SUM))
    return [found[i, 0] for i in range(dim)]


def products(rows: DataFrame, dim: int, centre: list[int]) -> np.ndarray:
    """Sum over the rows of the products of ``x - centre``, exact."""
    upper = np.triu_indices(dim)
    middle = np.array(centre, np.int64)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        for batch in batches:
            for _, _, v in slices(batch, dim):
                total = total + exact_gram(integers(v) - middle)
        yield _decimals(*upper, list(total[upper]))

    out = np.zeros((dim, dim), object)
    for (i, j), t in _totals(rows.select("vector").mapInArrow(partial, _SUM)).items():
        out[i, j] = out[j, i] = t
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted model; as large as a few covariances. ``centre`` is the floor
    of the mean and ``rest`` what the sums leave over it, below n."""
    n: int
    centre: list[int]
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]

    def project(self, values: np.ndarray) -> np.ndarray:
        centred = (integers(values) - np.array(self.centre, np.int64)) - np.array([r / self.n for r in self.rest])
        return centred @ (self.vectors / np.sqrt(self.values))

    def deviations(self, values: np.ndarray) -> list[int | None]:
        """Sums of ``(n * x - S)**2``, exact; None beyond a long."""
        y, rest = integers(values) - np.array(self.centre, np.int64), np.array(self.rest, object)
        about = ((y - np.array([r / self.n for r in self.rest])) ** 2).sum(axis=1) * float(self.n) ** 2
        if len(y) and about.max() < 2.0 ** 62 and self.n < 2 ** 31 and np.abs(y).max() < 2 ** 31:
            t = y * self.n - rest.astype(np.int64)
            return (t * t).sum(axis=1).tolist()
        out: list[int | None] = [None] * len(y)
        for k in np.flatnonzero(about < 2.0 ** 64):
            total = sum(t * t for t in y[k].astype(object) * self.n - rest)
            out[k] = total if total < 2 ** 63 else None
        return out


def fit(rows: DataFrame, dim: int, n: int, most: int = COMPONENTS) -> Whitening:
    """Model of all rows: exact covariance, then its eigenvectors."""
    s = sums(rows, dim)
    centre, rest = [t // n for t in s], [t % n for t in s]
    r = np.array(rest, object)
    exact = products(rows, dim, centre) * n - np.outer(r, r)  # n * n times the covariance
    v = np.array([[np.longdouble(str(t)) for t in row] for row in exact], np.longdouble) / np.longdouble(str(n * n))
    values, vectors = qdwh.components(v)
    keep = int((values > LEAST_SHARE * max(values[0], 0)).sum()) if values[0] > 0 else 0
    keep = min(keep, most)
    return Whitening(n, centre, rest, values[:keep].astype(float), vectors[:, :keep].astype(float), float(np.trace(v)))


def identity_error(rows: DataFrame, dim: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity; its sums are tables of components by components."""
    k = len(model.values)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, _, v in slices(batch, dim):
                w = model.project(v)
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.indices(total.shape)
        yield pa.record_batch([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)),
                               pa.array(total.ravel())], names=["i", "j", "total"])

    total = np.zeros((k + 1, k))
    for r in (rows.select("vector").mapInArrow(partial, "i int, j int, total double")
              .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()):
        total[r["i"], r["j"]] = r["total"]
    mean = total[k] / model.n  # the rows are centred already: next to nothing
    return float(np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, dim: int, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): every row's components as one array."""
    out = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            for at, end, v in slices(batch, dim):
                w = model.project(v)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (end - at + 1) * k, k, dtype=np.int32)), pa.array(w.ravel()))
                yield pa.record_batch([batch.column("vec_id").slice(at, end - at), pa.array(model.deviations(v), pa.int64()),
                                       lists], schema=out)

    return rows.select("vec_id", "vector").mapInArrow(each, "vec_id long, deviation long, whitened array<double>")


def whiten(table: DataFrame, vector: str = "embedding", id: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """Whitened components of every vector, a row for each component.

    Columns: vec_id, component (from 1, by falling eigenvalue), n, deviation,
    whitened, explained and identity_error; the last is one value for all.
    An entry c counts as ``floor(64 * c) + 1000000``.

    Left out are vectors that are null or empty, hold a null, non-finite or
    huge entry (2**54 and more), or have another length than most. Repeated
    rows and ids count and are returned each; a null id is kept. deviation is
    null where it is no long. A direction without variance (eigenvalue up to
    1e-12 of the largest) is no component, so a table of equal vectors, of one
    or of none gives an empty result; vectors of a tied eigenvalue are any
    orthonormal ones of its space. Other columns are not read.
    """
    rows, dim, n = of_one_length(fit_rows(table, vector, id))
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    empty = table.sparkSession.createDataFrame([], schema)
    if n == 0:
        return empty
    model = fit(rows, dim, n, most)
    if len(model.values) == 0:
        return empty
    share = F.array(*[F.lit(x) for x in model.explained])
    return (whitened(rows, dim, model)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(share, F.col("at")).alias("explained"),
                    F.lit(identity_error(rows, dim, model)).alias("identity_error")))
