import pytest
from pyspark.sql import functions as F

from quarry import operators as op

NUMS = [6, 2, 6, 9, 7, 2, 8]


@pytest.fixture()
def nums(spark):
    return spark.createDataFrame([(x,) for x in NUMS], "value int")


def ints(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "value int")


def col(df, c="value"):
    return [r[c] for r in df.collect()]


def test_number_literals(spark, nums):
    assert sorted(col(nums.select((F.col("value") * F.col("value")).alias("value")))) == [4, 4, 36, 36, 49, 64, 81]
    assert sorted(col(op.distinct_values(nums, "value"))) == [2, 6, 7, 8, 9]
    assert op.total(nums, "value").first().total == 40
    assert op.total(nums, "value", zero=0).first().total == 40
    r = op.sum_count_mean(nums, "value").first()
    assert (r.total, r["count"]) == (40, 7) and abs(r.mean - 40 / 7) < 1e-12
    cbv = {r.value: r["count"] for r in op.count_by_value(nums, "value").collect()}
    assert cbv == {2: 2, 6: 2, 7: 1, 8: 1, 9: 1}
    assert col(op.top_n(nums, 3, "value")) == [9, 8, 7]
    assert col(op.top_n(nums, 3, "value", ascending=True)) == [2, 2, 6]
    assert col(op.first_row(nums, "value")) == [2]
    assert op.count_rows(nums).first()["count"] == 7


def test_reduce_vs_fold_on_empty(spark):
    empty = ints(spark, [])
    assert op.total(empty, "value").first().total is None
    assert op.total(empty, "value", zero=0).first().total == 0


def test_set_operations(spark):
    a, b = ints(spark, [10, 20, 30, 40]), ints(spark, [30, 40, 50])
    assert sorted(col(op.union_all(a, b))) == [10, 20, 30, 30, 40, 40, 50]
    assert sorted(col(op.intersect_distinct(a, b))) == [30, 40]
    assert sorted(col(op.subtract_keep_dups(a, b))) == [10, 20]
    assert sorted(col(op.except_distinct(a, b))) == [10, 20]


def test_set_operations_with_duplicates_and_nulls(spark):
    a, b = ints(spark, [1, 1, 2, 3, None, None]), ints(spark, [2, 2, None])
    assert sorted(col(op.subtract_keep_dups(a, b))) == [1, 1, 3]
    assert sorted(col(op.except_distinct(a, b))) == [1, 3]
    assert col(op.intersect_distinct(ints(spark, [1, 1, 2, 3]), ints(spark, [2, 2]))) == [2]
    assert col(op.intersect_distinct(a, ints(spark, [None, 7]))) == [None]
    assert op.union_all(ints(spark, [1, 1, 2, 3]), ints(spark, [2, 2])).count() == 6


SCORES = [("north", 8), ("south", 1), ("north", 6), ("west", 9), ("south", 5), ("north", 1)]


def test_pair_aggregates(spark):
    p = spark.createDataFrame(SCORES, "key string, value int")
    assert {r.key: r["count"] for r in op.count_by_key(p, "key").collect()} == {"north": 3, "south": 2, "west": 1}
    assert {r.key: r.mean for r in op.mean_by_key(p, "key", "value").collect()} == {"north": 5.0, "south": 3.0, "west": 9.0}
    g = {r.key: r["values"] for r in op.collect_by_key(p, "key", "value").collect()}
    assert g == {"north": [1, 6, 8], "south": [1, 5], "west": [9]}
    assert {r.key: r.total for r in op.sum_by_key(p, "key", "value").collect()} == {"north": 15, "south": 6, "west": 9}


def test_joins_and_cogroup(spark):
    x = spark.createDataFrame([("a", 1), ("b", 4)], "k string, x int")
    y = spark.createDataFrame([("a", 2), ("a", 3)], "k string, y int")
    inner = sorted(tuple(r) for r in op.join_by_key(x, y, "k").collect())
    assert inner == [("a", 1, 2), ("a", 1, 3)]
    left = sorted(tuple(r) for r in op.join_by_key(x, y, "k", "left").collect())
    assert left == [("a", 1, 2), ("a", 1, 3), ("b", 4, None)]
    right = sorted(tuple(r) for r in op.join_by_key(x, y, "k", "right").collect())
    assert right == [("a", 1, 2), ("a", 1, 3)]
    cg = {r.k: (r.left, r.right) for r in op.cogroup(x, y, "k", "x", "y").collect()}
    assert cg == {"a": ([1], [2, 3]), "b": ([4], [])}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_split_deals_hot_keys(spark, monkeypatch, how):
    from quarry.operators import joins
    monkeypatch.setattr(joins, "MIN_HOT_ROWS", 5)
    left = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3), ("alone", 4), (None, 5)], "k string, x int")
    right = spark.createDataFrame([("hot", i) for i in range(200)] + [("cold", -1), (None, -2), ("other", -3)], "k string, y int")
    split = op.join_split(left, right, "k", how)
    assert split.columns == ["k", "x", "y"]
    want = left.join(right, "k", how)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, want.collect()))
    assert "_salt" in split._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rank_rows", [1_000_000, 3])
def test_lists_are_cut_in_order(spark, monkeypatch, rank_rows):
    from quarry.operators import chunks
    monkeypatch.setattr(chunks, "RANK_ROWS", rank_rows)
    values = [7] * 25 + list(range(40)) + [None, None]
    df = spark.createDataFrame([("hot", v) for v in values] + [("cold", 1), (None, 2)], "k string, v int").repartition(4)
    out = {(r.k, r.chunk): r["values"] for r in op.grouped_lists(df, "k", "v", chunk_rows=10).collect()}
    hot = [None, None] + sorted(v for v in values if v is not None)
    assert out == {**{("hot", i): hot[10 * i:10 * i + 10] for i in range(7)}, ("cold", 0): [1], (None, 0): [2]}
    pairs = df.withColumn("w", F.lit("x"))
    both = op.grouped_lists(pairs, "k", ["v", "w"], chunk_rows=1000).filter("k = 'hot'").first()["values"]
    assert [r.v for r in both] == hot


def test_cogroup_chunks_hold_both_sides(spark):
    left = spark.createDataFrame([("hot", i) for i in range(25)] + [("cold", 1)], "k string, v int")
    right = spark.createDataFrame([("hot", 7)] * 12 + [("only_right", 2), (None, 3)], "k string, v int")
    out = {(r.k, r.chunk): (r.left, r.right) for r in op.cogroup(left, right, "k", "v", "v", chunk_rows=10).collect()}
    assert out == {("hot", 0): (list(range(10)), [7] * 10), ("hot", 1): (list(range(10, 20)), [7, 7]),
                   ("hot", 2): (list(range(20, 25)), []), ("cold", 0): ([1], []), ("only_right", 0): ([], [2]),
                   (None, 0): ([], [3])}
    with pytest.raises(ValueError):
        op.cogroup(left, right, "k", "v", "v", chunk_rows=0)


def test_grouped_lists_null_key_and_values(spark):
    df = spark.createDataFrame([(None, 1), (None, None), ("a", 2)], "k string, v int")
    got = {(r.k, r.chunk): r["values"] for r in op.grouped_lists(df, "k", "v").collect()}
    assert got == {(None, 0): [None, 1], ("a", 0): [2]}


def test_count_where_single_pass(spark):
    df = spark.createDataFrame([("abc",), ("b",), ("x",)], "value string")
    r = op.count_where(df, a=F.col("value").contains("a"), b=F.col("value").contains("b")).first()
    assert (r.a, r.b) == (1, 2)


def test_sampling(spark, nums):
    big = spark.range(0, 1000).withColumnRenamed("id", "value")
    s = op.sample_fraction(big, 0.5, seed=1)
    assert 350 < s.count() < 650 and s.subtract(big).count() == 0
    n = op.sample_n_with_replacement(nums, 3, seed=3)
    got = col(n)
    assert len(got) == 3 and set(got) <= set(NUMS)
    parts = op.tagged_split(big, [0.8, 0.2], seed=5)
    assert parts.count() == 1000 and parts.select("value").distinct().count() == 1000
    assert set(col(parts, "split")) == {0, 1}


def test_persisted_and_spread(spark, nums):
    with op.persisted(nums) as p:
        assert p.is_cached and p.count() == 7
    assert not nums.is_cached
    one = nums.coalesce(1)
    assert op.spread(one, 4).rdd.getNumPartitions() == 4
    many = nums.repartition(6)
    assert op.spread(many, 4).rdd.getNumPartitions() == 4
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "no job at build time")
    grouped = nums.groupBy("value").count()
    assert op.spread(grouped) is grouped and not jobs.getJobIdsForGroup("spread")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert op.coalesce_to(many, 2).rdd.getNumPartitions() == 2


@pytest.mark.parametrize("bound", [60_000, 2_000, 30])
def test_frequent_keys_are_counted_exactly(spark, bound):
    from quarry.operators import hot
    df = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 10 == 1, -1).otherwise(F.col("id") % 3001).alias("a"))
    rows, limit, keys = hot.frequent_keys(df, ["a"], lambda n: bound)
    want = {r["a"]: r["n"] for r in df.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > bound).collect()}
    assert (rows, limit) == (120_000, bound)
    assert ({r["a"]: r["_n"] for r in keys.collect()} if keys is not None else {}) == want
    assert bool(want) == (bound < 60_000)


def test_no_hot_keys_no_second_pass(spark):
    from quarry.operators import hot
    df = spark.range(50_000).select((F.col("id") % 10_000).alias("k"))
    assert hot.frequent_keys(df, ["k"], lambda n: 10_000)[2] is None
    assert hot.frequent_keys(df.limit(0), ["k"], lambda n: 0)[2] is None


def test_join_split_on_several_and_structured_keys(spark, monkeypatch):
    from quarry.operators import joins
    monkeypatch.setattr(joins, "MIN_HOT_ROWS", 50)
    right = spark.range(3_000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("a"), F.lit("z").alias("b"),
                                      F.struct(F.when(F.col("id") % 5 > 0, F.lit(1))).alias("s"), "id")
    for on in (["a", "b"], ["s"]):
        left = right.groupBy(*on).agg(F.count("*").alias("n"))
        got = op.join_split(left, right.select(*on, "id"), on)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, left.join(right.select(*on, "id"), on).collect()))
        assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
