import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import codes, queries
from quarry.session import table_path

DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Codes by plain distances in Python's integers."""
    width = -(-len(rows[0][1]) // parts)
    ints = [[int(np.floor(256.0 * float(c))) for c in v] + [0] * (width * parts - len(v)) for _, v, _ in rows]
    x = np.array(ints, object).reshape(len(rows), parts, width)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = np.array([x[i] for i in first], object).transpose(1, 0, 2)

    def assign():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return [[min(range(d.shape[2]), key=lambda k: r[p][k]) for p in range(parts)] for r in d], d.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        index, _ = assign()
        new = books.copy()
        for p in range(parts):
            for k in range(books.shape[1]):
                own = [x[i, p] for i in range(len(rows)) if index[i][p] == k]
                if own:
                    new[p, k] = sum(own) // len(own)
        books = new
    index, error = assign()
    by_label = defaultdict(int)
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e
    sha = hashlib.sha256(",".join(str(c) for c in books.ravel()).encode()).hexdigest()
    long = lambda v: int(v) if v < 2 ** 63 else None
    return sorted(((i, "".join(f"{k:02x}" for k in code), long(e), long(by_label[label]) if long(e) is not None else None, sha)
                   for (i, _, label), code, e in zip(rows, index, error)), key=str)


def found(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(table_path(DIR, "embeddings")).collect()]
    spark.createDataFrame(rows, VECTORS).repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert found(queries.op13_vector_codes(spark, str(tmp_path))) == brute(rows)


@pytest.mark.parametrize("dim, parts, entries", [(7, 3, 5), (12, 4, 300 // 2), (5, 16, 4), (1, 1, 2)])
def test_any_width_and_ties(spark, dim, parts, entries):
    rng = np.random.default_rng(dim)
    rows = [(i % 50, [float(x) / 4 for x in rng.integers(-3, 4, dim)], int(i % 3) if i % 4 else None) for i in range(120)]
    df = spark.createDataFrame(rows, VECTORS)
    assert found(codes.compress(df, parts=parts, entries=entries)) == brute(rows, parts, entries)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(6)
    for top in (1e4, 1e8):
        rows = [(i, [float(np.float32(x)) for x in rng.uniform(-top, top, 8)], 0 if i else None) for i in range(30)]
        assert found(codes.compress(spark.createDataFrame(rows, VECTORS), parts=2, entries=4)) == brute(rows, 2, 4)
    mixed = [(i, [0.5, float(i), -float(i) / 3, 2.0 ** 40 if i == 7 else 1.0], 0) for i in range(20)]
    got = codes.compress(spark.createDataFrame(mixed, VECTORS), parts=2, entries=4).collect()
    assert len(got) == 20


def test_left_out_rows_nulls_and_empty(spark):
    good = [(i, [float(i % 5), float(i % 3)], None) for i in range(20)] + [(None, [9.0, 9.0], 1), (3, [3.0, 0.0], None)]
    bad = [(50, None, 1), (51, [], 1), (52, [1.0, None], 1), (53, [1.0, float("nan")], 1), (54, [float("-inf"), 0.0], 1),
           (55, [1.0, 2.0, 3.0], 1), (56, [3e38, 0.0], 1)]
    df = spark.createDataFrame(good + bad, VECTORS).select("*", *[F.lit(1).alias(c) for c in ("of", "code", "error", "vector", "a.b")])
    assert found(codes.compress(df, parts=2, entries=8)) == brute(good, 2, 8)
    empty = codes.compress(spark.createDataFrame(bad[:5], VECTORS))
    assert empty.collect() == [] and empty.columns == codes.compress(df, parts=2, entries=8).columns


def test_a_hot_label_is_dealt_out(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("vec_id"), F.array((F.col("id") % 97) / 8.0, (F.col("id") % 31) / 4.0).cast("array<float>").alias("embedding"),
        F.when(F.col("id") % 3 > 0, 1).cast("int").alias("label"))
    got = codes.compress(rows, parts=1, entries=16)
    by = {r.label: (r.n, r.e, r.m) for r in got.groupBy("label").agg(
        F.count("*").alias("n"), F.sum("error").alias("e"), F.max("label_error").alias("m")).collect()}
    assert by[None][0] == 10_000 and by[1][0] == 20_000
    assert all(e == m for _, e, m in by.values())


def test_transform_keeps_distances_in_order_of_sign_changes():
    rng = np.random.default_rng(7)
    for width in (1, 2, 3, 4, 7, 16):
        a, b = rng.integers(-99, 99, (2, 50, width))
        size = 1 << (width - 1).bit_length()
        assert (((codes.spectrum(a) - codes.spectrum(b)) ** 2).sum(axis=1) == size * ((a - b) ** 2).sum(axis=1)).all()
        rows = codes.transform(np.eye(size, dtype=np.int64))[codes.sequency_order(size)]
        assert ((np.diff(rows, axis=1) != 0).sum(axis=1) == np.arange(size)).all()


def test_nearest_prefers_the_lower_index():
    entries = codes.spectrum(np.array([[5, 5], [1, 1], [1, 1], [3, 1]]))
    index, error = codes.nearest(codes.spectrum(np.array([[2, 1], [1, 1], [9, 9]])), entries)
    assert index.tolist() == [1, 1, 0] and (error // 2).tolist() == [1, 0, 32]
