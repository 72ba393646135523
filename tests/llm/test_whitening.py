import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import qdwh, queries, whitening
from quarry.session import table_path

DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def brute(vectors):
    x = np.array([[int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    c = (x * n - s).astype(float) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-values)
    return deviation, c, values[order], axes[:, order]


@pytest.mark.parametrize("parts", [1, 7])
def test_query_equals_numpy(spark, parts, tmp_path):
    rows = spark.read.parquet(table_path(DIR, "embeddings")).collect()
    spark.createDataFrame(rows, VECTORS).repartition(parts).write.parquet(str(tmp_path / "embeddings.parquet"))
    deviation, c, values, axes = brute([r.embedding for r in rows])
    expected = c @ axes[:, :32] / np.sqrt(values[:32])
    got = queries.op11_embedding_whitening(spark, str(tmp_path)).toPandas()
    assert len(got) == 32 * len(rows) and set(got.n) == {len(rows)}
    ids = [r.vec_id for r in rows]
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.abs(w - expected * np.sign((w * expected).sum(axis=0))).max() < 1e-8
    first = got[got.component == 1].set_index("vec_id").loc[ids]
    assert first.deviation.tolist() == deviation
    share = got.groupby("component").explained.first().to_numpy()
    assert np.abs(share / (values[:32] / values.sum()) - 1).max() < 1e-9
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    cov = w.T @ w / len(w)
    assert np.abs(cov - np.eye(32)).max() < 1e-9


def test_left_out_rows_nulls_and_repeats(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(x) for x in rng.standard_normal(3)], None) for i in range(40)]
    good += [good[0], (None, [1.0, 2.0, 3.0], 1)]
    bad = [(50, None, 1), (51, [], 1), (52, [1.0, None, 2.0], 1), (53, [1.0, float("nan"), 2.0], 1),
           (54, [float("inf"), 0.0, 0.0], 1), (55, [1.0, 2.0], 1), (56, [3e38, 0.0, 0.0], 1)]
    df = spark.createDataFrame(good + bad, VECTORS).withColumn("component", F.lit(1)).withColumn("a.b", F.lit(2))
    got = whitening.whiten(df).collect()
    assert len(got) == 42 * 3 and {r.n for r in got} == {42}
    assert sum(r.vec_id == 0 for r in got) == 6 and sum(r.vec_id is None for r in got) == 3


def test_without_variance_there_are_no_components(spark):
    def of(rows):
        return whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert of([]) == [] and of([(1, None, None)]) == []
    assert of([(1, [1.0, 2.0], 0)]) == [] and of([(i, [1.0, 2.0], 0) for i in range(9)]) == []
    flat = of([(i, [float(i), float(2 * i), 5.0], 0) for i in range(9)])
    assert {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(2)
    for top in (1e3, 2e5, 3e12, 1e15):
        rows = [(i, [float(x) for x in np.float32(rng.uniform(-top, top, 2))], 0) for i in range(30)]
        deviation, _, values, _ = brute([r[1] for r in rows])
        got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).filter("component = 1").orderBy("vec_id").collect()
        assert [r.deviation for r in got] == [d if d < 2 ** 63 else None for d in deviation]
        assert got[0].explained == pytest.approx(values[0] / values.sum(), rel=1e-9)


def test_exact_gram():
    rng = np.random.default_rng(3)
    for top in (10, 2 ** 21, 2 ** 39, 2 ** 55):
        y = rng.integers(-top, top, (4096, 3))
        o = y.astype(object)
        assert (whitening.exact_gram(y) == o.T @ o).all()
    mixed = np.concatenate([rng.integers(-9, 9, (50, 3)), rng.integers(-2 ** 50, 2 ** 50, (3, 3))])
    assert (whitening.exact_gram(mixed) == mixed.astype(object).T @ mixed.astype(object)).all()


@pytest.mark.parametrize("values", [
    [5.0], [2.0, 2.0], [0.0, 0.0, 0.0], list(range(40)), [1.0] * 20 + [3.0] * 20, [1e6] + [1.0] * 10, [10.0 ** -k for k in range(12)],
    [1.0, 1.0 + 1e-9, 1.0 - 1e-9, 7.0], [-3.0, 3.0, -3.0, 3.0]])
def test_eigenvectors(values):
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    a = (q * np.array(values)) @ q.T
    a = (a + a.T) / 2
    found, x = qdwh.components(a.astype(np.longdouble))
    top = max(np.abs(a).max(), 1e-300)
    assert np.abs(found.astype(float) - np.sort(np.linalg.eigvalsh(a))[::-1]).max() < 1e-13 * top * len(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-14
    assert np.abs(a @ x - x * found).max() < 1e-13 * top


def test_polar_factor_is_orthogonal():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    u = qdwh.polar(a)
    values, axes = np.linalg.eigh(a)
    assert np.abs(u - (axes * np.sign(values)) @ axes.T).max() < 1e-13
