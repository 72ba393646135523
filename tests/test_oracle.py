"""Every registered query against its DuckDB SQL on the smallest tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_all_registered_queries_match_oracle(spark):
    from tools.oracle_check import compare
    rep = compare(spark, SF)
    bad = {k: v for k, v in rep.items()
           if "error" in v or (("values_match" in v) and not v["values_match"])}
    assert not bad, bad


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["title", "votes", "rate"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_coverage_map_names_only_registered_queries():
    import re

    import __spark_entry__ as e
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    text = open(os.path.join(root, "COVERAGE.md"), encoding="utf-8").read()
    rows = [ln.split("|") for ln in text.splitlines() if re.match(r"\| [A-Z]+\d+ \|", ln)]
    assert len(rows) == 116
    named = {m for r in rows for m in re.findall(r"([a-z][a-z0-9_]+) \((?:O|R)", r[3])}
    assert named and named <= set(e.queries()), named - set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_bench_prints_one_json_line():
    import json
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "best_rated_inner", "top_n"],
                         capture_output=True, text=True, timeout=600, env=env, cwd=root)
    assert out.returncode == 0, out.stderr[-2000:]
    rec = json.loads(out.stdout.strip().splitlines()[-1])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"best_rated_inner", "top_n"}
    assert rec["value"] > 0 and rec["sf"] == 0.001
