import pytest
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.operators import sampling


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def repeated(spark):
    """Rows with equal copies, nulls and a name with a dot."""
    return spark.range(3_000).select((F.col("id") % 700).alias("a.b"), F.when(F.col("id") % 3 > 0, "x").alias("c"))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(sampling, "COPIES", 10)


def test_splits_hold_under_another_partitioning(spark, repeated):
    for w in ([0.8, 0.2], [1, 2, 3]):
        one, two = op.tagged_split(repeated, w, 3), op.tagged_split(repeated.repartition(7, "c"), w, 3)
        assert rows(one) == rows(two) and one.count() == 3_000
        assert rows(one.drop("split")) == rows(repeated)
        assert rows(one) != rows(op.tagged_split(repeated, w, 4))
    parts = op.random_split(repeated, [0.5, 0.5], 3)
    assert sum(p.count() for p in parts) == 3_000 and all(1_200 < p.count() < 1_800 for p in parts)
    half = op.sample_fraction(repeated, 0.5, 3)
    assert rows(half) == rows(op.sample_fraction(repeated.coalesce(1), 0.5, 3))


def test_copies_of_a_row_go_different_ways(spark, small_blocks):
    """A row that a third of the table equals is numbered in blocks."""
    df = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        n = sampling.numbered_copies(df)
        assert "_block" in n._jdf.queryExecution().analyzed().toString()
        got = {r["k"]: (r["n"], r["most"], r["d"]) for r in n.groupBy("k").agg(
            F.count("*").alias("n"), F.max("_copy").alias("most"), F.count_distinct("_copy").alias("d")).collect()}
        assert got[-1] == (2_000, 1_999, 2_000) and len(got) == 4_001 and set(got.values()) == {(2_000, 1_999, 2_000), (1, 0, 1)}
        share = op.sample_fraction(df, 0.25, 1).filter("k = -1").count()
        assert 380 < share < 620
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("n", [1, 50, 40_000])
def test_draws_are_exact_and_hold_under_another_partitioning(spark, repeated, n):
    one = op.sample_n_with_replacement(repeated, n, 5)
    assert one.count() == n and one.columns == repeated.columns
    assert one.join(repeated.distinct(), (one["`a.b`"] == repeated["`a.b`"]) & one["c"].eqNullSafe(repeated["c"]), "left_semi").count() == n
    assert rows(one) == rows(op.sample_n_with_replacement(repeated.repartition(5), n, 5))


def test_draws_follow_the_multiplicities(spark, monkeypatch):
    monkeypatch.setattr(sampling, "SEGMENT", 64)
    df = spark.range(3_000).select(F.when(F.col("id") < 1_000, -1).otherwise(F.col("id")).alias("k"))
    got = {r["k"]: r["n"] for r in op.sample_n_with_replacement(df, 30_000, 2).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert abs(got[-1] - 10_000) < 6 * 82
    others = [got.get(k, 0) for k in range(1_000, 3_000)]
    mean = sum(others) / len(others)
    var = sum((x - mean) ** 2 for x in others) / len(others)
    assert abs(mean - 10) < 0.3 and 8 < var < 12


def test_nothing_to_draw_from(spark, repeated):
    assert op.sample_n_with_replacement(repeated.limit(0), 5, 1).collect() == []
    assert op.sample_n_with_replacement(repeated, 0, 1).collect() == []
    assert op.tagged_split(repeated.limit(0), [1, 1], 1).collect() == []
    assert op.sample_fraction(repeated, 0.0, 1).collect() == [] and op.sample_fraction(repeated, 1.0, 1).count() == 3_000


def test_no_stage_of_the_draws_is_one_task(spark, repeated):
    plan = op.sample_n_with_replacement(repeated, 1_000, 1)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_sampling_with_replacement_by_fraction(spark, repeated):
    assert 2_400 < op.sample_fraction(repeated, 1.0, 1, with_replacement=True).count() < 3_600
