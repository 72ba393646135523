import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.plans import catalog
from quarry.session import work_path
from quarry.sources.sinks import write_bucketed

NAMES = ["plain", "a.b", "with blank", "tick`ed", "v) FROM x --", "ünï'code\"", "select"]


@pytest.mark.parametrize("name", NAMES)
def test_any_column_name(spark, name):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 3.0, 1), ("b", 5.0, 9)], "k string, x double, other int").toDF(name, name + "2", "other")
    catalog.register_views(spark, ratings=df)
    got = catalog.mean_by_key_sql(spark, "ratings", name, name + "2", name="mean of " + name)
    assert got.columns == [name, "mean of " + name] and sorted(map(tuple, got.collect())) == [("a", 2.0), ("b", 5.0)]
    got = catalog.count_by_key_sql(spark, "ratings", name, name="n of " + name)
    assert [tuple(r) for r in got.collect()] == [("a", 2), ("b", 1)]
    movies = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "k string, t string").toDF(name, "title " + name)
    catalog.register_views(spark, movies=movies)
    best = catalog.best_rated_sql(spark, "movies", "ratings", name, "title " + name, name, name + "2", min_votes=0)
    assert [tuple(r) for r in best.collect()] == [("B", 1, 5.0), ("A", 2, 2.0), ("C", 1, None)]


@pytest.mark.parametrize("name", NAMES)
def test_any_view_name(spark, name):
    df = spark.createDataFrame([(1,)], "x int")
    catalog.register_views(spark, **{name: df})
    assert catalog.select_all(spark, name).collect() == df.collect()
    assert catalog.register_global_view(spark, df, name).collect() == df.collect()


def test_names_of_several_parts_and_hostile_ones(spark):
    catalog.register_global_view(spark, spark.range(3), "three")
    assert catalog.select_all(spark, "global_temp.three").count() == 3
    for view in ("three; DROP VIEW x", "(SELECT 1)", "no such view"):
        with pytest.raises(PySparkException):
            catalog.select_all(spark, view).collect()


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    run = uuid.uuid4().hex[:8]
    a = spark.range(500).select((F.col("id") % 50).alias("k"), "id")
    b = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    x, y = (write_bucketed(df, f"t_{n}_{run}", ["k"], 4, work_path(spark, "bucketed")) for n, df in (("a", a), ("b", b)))
    j = op.join_by_key(x, y, "k", strategy="merge")
    assert sorted(map(tuple, j.collect())) == sorted(map(tuple, a.join(b, "k").collect()))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    grouped = x.groupBy("k").count()
    assert grouped.count() == 50 and "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()


def test_bucketed_query_has_no_exchange(spark):
    from quarry.plans import bindings
    plan = bindings.QUERIES["bucketed_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
