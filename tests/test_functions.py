import pytest
from pyspark.sql import functions as F

from quarry.functions import first_match, jvm_split, lines_of, split_multi, strip_header, token_count
from quarry.functions.nested import flatten_struct


def test_jvm_split_edge_cases(spark):
    df = spark.createDataFrame([("",), ("   ",), ("a b  ",), (" a",), ("a  b",), ("abc",)], "v string")
    got = [r.w for r in df.select(jvm_split("v").alias("w")).collect()]
    assert got == [[""], [], ["a", "b"], ["", "a"], ["a", "", "b"], ["abc"]]


def test_jvm_split_other_separator(spark):
    df = spark.createDataFrame([("1::2::3::::",), ("::x",), ("::::",)], "v string")
    got = [r.w for r in df.select(jvm_split("v", "::").alias("w")).collect()]
    assert got == [["1", "2", "3"], ["", "x"], []]


def test_token_counts(spark):
    lines = ["three short words", "only twö", "a line of six plain words"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.n for r in df.select(token_count("value").alias("n")).collect()] == [3, 2, 6]
    assert df.filter(F.col("value").contains("words")).count() == 2


def test_first_match(spark):
    df = spark.createDataFrame([("1@(500) Days (2009)@x",), ("2@No year@y",)], "value string")
    assert [r.y for r in df.select(first_match("value").alias("y")).collect()] == ["500", ""]


def test_split_multi_is_literal(spark):
    df = spark.createDataFrame([("A|B|C",)], "g string")
    assert df.select(split_multi("g", "|").alias("s")).first().s == ["A", "B", "C"]


def test_strip_header(spark):
    df = spark.createDataFrame([(bytearray([0, 0, 0, 0, 1, 2, 3]),)], "value binary")
    assert bytes(df.select(strip_header("value").alias("b")).first().b) == bytes([2, 3])


def test_flatten_struct(spark):
    df = spark.createDataFrame([(1, (2, (3, "x")))], "k int, m struct<a:int, p:struct<b:int, c:string>>")
    out = flatten_struct(df, "m", keep=["k"])
    assert out.columns == ["k", "a", "b", "c"]
    assert tuple(out.first()) == (1, 2, 3, "x")


def test_flatten_struct_refuses_one_name_twice(spark):
    df = spark.createDataFrame([(1, (2, (3,)))], "id int, m struct<a:int, p:struct<ID:int>>")
    with pytest.raises(ValueError, match="id"):
        flatten_struct(df, "m", keep=["id"])
    assert flatten_struct(df, "m", keep=["id"], sep=".").columns == ["id", "a", "p.ID"]


def test_lines_end_as_in_files(spark):
    texts = ["a b\r\na b\r\n", "x\ry\nz", "", "\n", "one", "two\n\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.v for r in df.select(lines_of("t").alias("v")).collect()] == [
        ["a b", "a b"], ["x", "y", "z"], [""], [""], ["one"], ["two", ""], None]
