"""Plan-shape and hot-key checks: what must still hold at 1000x the data."""

import os
import shutil
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.plans import bindings

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")

BATCH = sorted(n for n, f in bindings.QUERIES.items() if f.__module__ == "quarry.plans.bindings")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_join_anywhere(spark):
    for name in BATCH:
        plan = _plan(bindings.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_all_work_stays_in_the_jvm(spark):
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                    "FlatMapCoGroupsInPandas", "PythonUDF")
    for name in BATCH:
        plan = _plan(bindings.QUERIES[name](spark, SF))
        assert not any(n in plan for n in python_nodes), name


def test_filters_reach_the_scan_and_columns_are_pruned(spark):
    plan = _plan(bindings.QUERIES["numeric_filter"](spark, SF))
    assert "LessThan(l_quantity,2.0)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in plan
    plan = _plan(bindings.QUERIES["best_rated_inner"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_best_rated_aggregates_ratings_before_the_join(spark):
    lines = _plan(bindings.QUERIES["best_rated_inner"](spark, SF)).splitlines()
    join = next(i for i, ln in enumerate(lines) if "Join" in ln)
    pre = [i for i, ln in enumerate(lines) if "HashAggregate(keys=[l_partkey" in ln and "partial_" in ln]
    assert pre and all(i > join for i in pre)  # the partial aggregate sits below the join


def test_every_grouping_is_partially_aggregated(spark):
    for name in ["word_count", "group_count", "sum_by_key", "latest_version", "mean_by_key"]:
        plan = _plan(bindings.QUERIES[name](spark, SF))
        assert "partial_" in plan, name


# ------------------------------------------------------------- hot keys

@pytest.fixture(scope="module")
def hot_dir():
    """Copies of the driver tables where one part, one supplier and one
    user hold about a third of all rows."""
    d = tempfile.mkdtemp(prefix="quarry-hot-")
    rng = np.random.default_rng(11)
    li = pq.read_table(f"{SF}/lineitem.parquet")
    hot = rng.random(li.num_rows) < 1 / 3
    for c in ["l_partkey", "l_suppkey"]:
        v = li[c].to_numpy().copy()
        v[hot] = 0
        li = li.set_column(li.schema.get_field_index(c), c, pa.array(v, pa.int64()))
    pq.write_table(li, f"{d}/lineitem.parquet")
    ev = pq.read_table(f"{SF}/events.parquet")
    u = ev["user_id"].to_numpy().copy()
    u[rng.random(ev.num_rows) < 1 / 3] = 0
    ev = ev.set_column(ev.schema.get_field_index("user_id"), "user_id", pa.array(u, pa.int64()))
    pq.write_table(ev, f"{d}/events.parquet")
    for t in ["part", "orders", "customer", "documents"]:
        shutil.copy(f"{SF}/{t}.parquet", f"{d}/{t}.parquet")
    return d


HOT_QUERIES = ["best_rated_inner", "best_rated_left", "best_rated_left_df", "mean_with_attributes",
               "inner_join", "right_join", "cogroup", "composite_join", "group_count", "group_mean",
               "sum_by_key", "mean_by_key", "collect_by_key", "mse", "top_by_count", "union_all",
               "intersect", "subtract_keep_dups", "except_distinct", "sql_count_order", "latest_version"]


def test_hot_key_results_match_oracle(spark, hot_dir):
    from tools.oracle_check import compare
    rep = compare(spark, hot_dir, HOT_QUERIES)
    bad = {k: v for k, v in rep.items() if not v.get("values_match")}
    assert not bad, bad


def test_hot_key_lists_are_bounded_and_complete(spark, hot_dir):
    import duckdb
    li = spark.read.parquet(f"{hot_dir}/lineitem.parquet")
    r = li.select(F.col("l_partkey").alias("key"), F.col("l_quantity").alias("v"))
    part = spark.read.parquet(f"{hot_dir}/part.parquet").select(F.col("p_partkey").alias("key"),
                                                                F.col("p_size").alias("v"))
    rows = op.cogroup(part, r, "key", "v", "v", chunk_rows=200).filter("key = 0").orderBy("chunk").collect()
    assert len(rows) > 5 and all(len(x.right) == 200 for x in rows[:-1])
    expect = [v for (v,) in duckdb.sql(
        f"SELECT l_quantity FROM read_parquet('{hot_dir}/lineitem.parquet') WHERE l_partkey = 0 ORDER BY 1").fetchall()]
    assert [v for x in rows for v in x.right] == expect


@pytest.mark.parametrize("name,key", [("mse", "l_partkey"), ("composite_join", "l_suppkey"), ("left_join", "o_custkey")])
def test_registered_joins_deal_a_hot_key_over_tasks(spark, monkeypatch, name, key):
    """Most rows of one task in the join's stage, counted by partition of the
    joined result, against the hot key's rows."""
    from quarry.operators import joins
    monkeypatch.setattr(joins, "MIN_HOT_ROWS", 50)
    d = tempfile.mkdtemp(prefix="quarry-hot1-")
    for t in ("lineitem", "orders", "customer"):
        data = pq.read_table(f"{SF}/{t}.parquet")
        for c in ("l_partkey", "l_suppkey", "o_custkey"):
            if c in data.column_names:
                v = data[c].to_numpy().copy()
                v[np.arange(len(v)) % 5 < 2] = 1
                data = data.set_column(data.schema.get_field_index(c), c, pa.array(v, pa.int64()))
        pq.write_table(data, f"{d}/{t}.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    seen = {}
    real = joins.join_split

    def watched(left, right, on, how="inner"):
        out = real(left, right, on, how)
        seen["most"] = max(r[1] for r in out.groupBy(F.spark_partition_id()).count().collect())
        return out

    monkeypatch.setattr(op, "join_split", watched)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        bindings.QUERIES[name](spark, d).count()
        table = "orders" if name == "left_join" else "lineitem"
        hot = pq.read_table(f"{d}/{table}.parquet", columns=[key])[key].to_numpy()
        assert seen["most"] < 0.5 * (hot == 1).sum()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_aqe_splits_a_skewed_join_partition(spark, hot_dir):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # several map tasks, as a large input has (a skewed partition is split
        # along map outputs)
        li = spark.read.parquet(f"{hot_dir}/lineitem.parquet").repartition(8).select(
            F.col("l_partkey").alias("p_partkey"), "l_orderkey")
        part = spark.read.parquet(f"{hot_dir}/part.parquet").select("p_partkey", "p_name")
        j = op.join_by_key(li, part, "p_partkey")
        n = len(j.collect())
        assert n == li.count()
        assert "SortMergeJoin(skew=true)" in _plan(j)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_scans_read_only_needed_columns(spark):
    import re
    widths = {t: len(pq.read_schema(f"{SF}/{t}.parquet"))
              for t in ["part", "lineitem", "events", "documents", "orders", "customer"]}
    full = set()
    for name in BATCH:
        plan = _plan(bindings.QUERIES[name](spark, SF))
        for table, schema in re.findall(
                r"\[file:[^\]]*/(\w+)\.parquet\].*?ReadSchema: struct<([^>]*)>", plan):
            if table in widths and schema.count(":") >= widths[table]:
                full.add(name)
    # SELECT * views, and the product messages that use every event column
    assert full == {"view_select", "global_view", "product_flat", "product_versions", "product_rejects"}, full
