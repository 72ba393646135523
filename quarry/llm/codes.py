"""Vector code compression: product codebooks over integers, searched in the
Walsh-Hadamard domain.

A vector's parts and the codebooks' entries are padded with zeros to a power
of two and transformed by integer additions; the transform multiplies squared
distances by that power of two and gathers most of them in the coefficients
of few sign changes. Scaled squared differences are added up in that order,
and an entry whose sum passes the whole distance of some other entry is
dropped, so the nearest entry is found exactly with few coefficients.
"""

from __future__ import annotations

import decimal
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import written
from quarry.llm.vectors import fit_rows, of_one_length, slices
from quarry.operators.joins import join_split

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
_LONG = 2 ** 63


def integers(values: np.ndarray) -> np.ndarray:
    """All floors go down."""
    return np.floor(SCALE * values).astype(np.int64)


def parts_of(x: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, width): equal consecutive parts, zeros after the last
    entry where the parts don't divide the vector."""
    width = -(-x.shape[1] // parts)
    if width * parts != x.shape[1]:
        x = np.concatenate([x, np.zeros((len(x), width * parts - x.shape[1]), x.dtype)], axis=1)
    return x.reshape(len(x), parts, width)


def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of a power of two by their sign changes."""
    h = transform(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform along the last axis, by sums and differences."""
    size, step = x.shape[-1], 1
    while step < size:
        pairs = x.reshape(*x.shape[:-1], size // (2 * step), 2, step)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(x.shape)
        step *= 2
    return x


def spectrum(x: np.ndarray) -> np.ndarray:
    """Coefficients of the zero-padded last axis, fewest sign changes first."""
    width = x.shape[-1]
    size = 1 << (width - 1).bit_length()
    if size != width:
        x = np.concatenate([x, np.zeros((*x.shape[:-1], size - width), x.dtype)], axis=-1)
    return transform(x)[..., sequency_order(size)]


def safe(width: int) -> int:
    """Integers up to this have scaled distances within a long."""
    size = 1 << (width - 1).bit_length()
    return isqrt(2 ** 60 // size ** 3)


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, scaled squared distance) of the nearest entry for the spectra
    of many parts, the lower index of a tie."""
    first = part[:, :1] - entries[None, :, 0]
    first = first * first
    guess = entries[first.argmin(axis=1)]
    bound = ((part - guess) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= bound[:, None])
    total = first[row, entry]
    for k in range(1, part.shape[1]):
        d = part[row, k] - entries[entry, k]
        total = total + d * d
        left = total <= bound[row]
        row, entry, total = row[left], entry[left], total[left]
    start = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(total, start)
    at = np.flatnonzero(total == np.repeat(least, np.diff(start, append=len(row))))
    at = at[np.flatnonzero(np.diff(row[at], prepend=-1))]
    return entry[at], least


@dataclass(frozen=True)
class Codebooks:
    """Integer entries of shape (parts, entries, width) for vectors of ``dim``."""
    dim: int
    entries: np.ndarray

    def __post_init__(self):
        wide = self.entries.size and max(abs(int(self.entries.max())), abs(int(self.entries.min()))) > safe(self.width)
        object.__setattr__(self, "_spectra", spectrum(self.entries.astype(object) if wide else self.entries))

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes, squared distances), both (rows, parts). Rows with numbers
        too large for longs are worked out in Python's integers."""
        cut = parts_of(x, len(self.entries))
        index, error = np.zeros(cut.shape[:2], np.int64), np.zeros(cut.shape[:2], object)
        large = np.abs(cut).reshape(len(cut), -1).max(axis=1) > safe(self.width)
        for rows, kind in ((~large, np.int64), (large, object)):
            if not rows.any():
                continue
            some = spectrum(cut[rows].astype(kind))
            for p in range(len(self.entries)):
                entry, total = nearest(some[:, p], self._spectra[p])
                index[rows, p], error[rows, p] = entry, (total // some.shape[2]).astype(object)
        return index, error


def first_codebooks(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the ``entries`` rows of smallest id (a missing id last,
    rows of one id by their vectors)."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    x = integers(np.array([r["vector"] for r in first], float).reshape(len(first), dim))
    return Codebooks(dim, np.ascontiguousarray(parts_of(x, parts).transpose(1, 0, 2)))


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, and an entry becomes
    the floor of its parts' mean. The tasks add up what they see, so a row
    for each number of the codebooks and task is shuffled."""
    parts, entries, width = books.entries.shape
    out = pa.schema([("at", pa.int32()), ("total", pa.decimal128(38, 0))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a number more for each entry: how many parts it has
        total = np.zeros((parts, entries, width + 1), object)
        for batch in batches:
            for _, _, v in slices(batch, books.dim):
                x = integers(v)
                index, _ = books.assign(x)
                cut = parts_of(x, parts)
                small = np.abs(x).max(initial=0) < 1 << 40  # sums of 4096 are exact in doubles
                for p in range(parts):
                    total[p, :, width] += np.bincount(index[:, p], minlength=entries).astype(object)
                    for k in range(width):
                        if small:
                            total[p, :, k] += np.bincount(index[:, p], cut[:, p, k].astype(float), entries).astype(np.int64).astype(object)
                        else:
                            np.add.at(total[p, :, k], index[:, p], cut[:, p, k].astype(object))
        flat = total.ravel()
        used = np.flatnonzero(flat != 0)
        wide = decimal.Context(prec=38)
        yield pa.record_batch([pa.array(used.astype(np.int32)),
                               pa.array([wide.create_decimal(int(t)) for t in flat[used]], pa.decimal128(38, 0))], schema=out)

    flat = np.zeros(parts * entries * (width + 1), object)
    for r in (rows.select("vector").mapInArrow(partial, "at int, total decimal(38,0)").groupBy("at")
              .agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()):  # the codebooks' numbers
        flat[r["at"]] = int(r["total"])
    total = flat.reshape(parts, entries, width + 1)
    count = total[:, :, width:]
    mean = np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books.entries.astype(object))
    return Codebooks(books.dim, mean.astype(np.int64))


def train(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks fitted on all rows."""
    books = first_codebooks(rows, dim, parts, entries)
    for _ in range(rounds):
        books = improved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Every row of (vec_id, vector, ...) with ``code`` (an entry's index in
    two hex digits for each part; codebooks have at most 256 entries) and
    ``error`` (the squared distances added up, null if no long) in place of
    its vector."""
    if books.entries.shape[1] > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    keep = [f for f in rows.schema.fields if f.name != "vector"]
    parts = len(books.entries)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, v in slices(batch, books.dim):
                index, error = books.assign(integers(v))
                digits = index.astype(np.uint8).tobytes().hex()
                codes = [digits[k:k + 2 * parts] for k in range(0, len(digits), 2 * parts)]
                errors = [e if e < _LONG else None for e in map(int, error.sum(axis=1))]
                yield pa.record_batch([*[batch.column(f.name).slice(at, end - at) for f in keep],
                                       pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                      names=[*[f.name for f in keep], "code", "error"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return rows.select(*[f.name for f in keep], "vector").mapInArrow(each, f"{schema}, code string, error long")


def compress(table: DataFrame, vector: str = "embedding", id: str = "vec_id", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of every vector: vec_id, label, code, error, label_error (errors
    added up over rows of an equal label, missing ones together) and
    codebooks_sha256, the same for all rows.

    Entries count as ``floor(256 * x)``. Codebooks start as the ``entries``
    rows of smallest id, a missing id last, and are averaged ``rounds`` times
    over all rows; a table of fewer rows has as many entries, and an entry
    without parts stays. Left out are vectors that are null or empty, hold a
    null, non-finite or huge entry (2**54 and more), or have another length
    than most. Where the parts don't divide the vectors, zeros follow the
    last entry. Repeated rows and ids count and are returned each. Errors that
    are no longs are null. An empty table gives an empty result; other columns
    are not read.
    """
    rows, dim, n = of_one_length(fit_rows(table, vector, id, label))
    if n == 0:
        kind = rows.schema["label"].dataType.simpleString()
        return table.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long, label_error long, codebooks_sha256 string")
    books = train(rows, dim, parts, entries, rounds)
    # a struct, so that missing labels are equal
    coded = written(encode(rows, books).withColumn("of", F.struct("label")), "codes")
    errors = coded.groupBy("of").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return join_split(errors, coded, "of").select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
