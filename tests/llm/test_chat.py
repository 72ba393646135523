from quarry.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def said(spark, rows):
    return chat.format_chats(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "part").collect()


def turns(conv, *texts, start=0):
    return [(conv, start + i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


def test_snapshots_collapse_into_the_longest(spark):
    rows = turns(1, "a") + turns(2, "a", "b") + turns(3, "a", "b", "c") + turns(4, "a", "x") + turns(5, "b", "b")
    out = said(spark, rows)
    assert [r.conv_id for r in out] == [3, 4, 5]
    assert out[0].text == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n"


def test_identical_conversations_keep_the_smallest_id(spark):
    out = said(spark, turns(9, "a", "b") + turns(4, "a", "b") + turns(6, "a"))
    assert [(r.conv_id, r.n_copies, r.n_turns) for r in out] == [(4, 2, 2)]


def test_role_and_turn_number_count(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "system", "a"), (2, 1, "user", "b"), (3, 1, "user", "a"), (3, 2, "user", "b")]
    assert [r.conv_id for r in said(spark, rows)] == [1, 2, 3]


def test_long_conversations_over_blocks(spark):
    long = [(1, i, "user", f"t{i}") for i in range(300)]
    rows = long + [(2, i, r, t) for _, i, r, t in long[:200]] + [(3, i, r, t if i != 100 else "other") for _, i, r, t in long[:200]]
    out = said(spark, rows)
    assert {r.conv_id for r in out} == {1, 3}
    assert sorted(r.part for r in out if r.conv_id == 1) == [0, 1, 2, 3, 4]
    assert "".join(r.text for r in out if r.conv_id == 1).count("<|end|>") == 300


def test_nulls_repeats_and_empty(spark):
    rows = [(None, 0, None, None), (None, 0, None, None), (1, None, "user", "x"), (1, 0, "user", "y"), (2, 0, "user", "")]
    out = said(spark, rows)
    assert [(r.conv_id, r.part, r.n_turns, r.text) for r in out] == [
        (None, 0, 1, "<||>\n<|end|>\n"), (1, -(2 ** 57), 2, "<|user|>\nx<|end|>\n"),
        (1, 0, 2, "<|user|>\ny<|end|>\n"), (2, 0, 1, "<|user|>\n<|end|>\n")]
    assert said(spark, []) == []


def test_other_columns_do_not_matter(spark):
    rows = spark.createDataFrame(turns(1, "a") + turns(2, "a", "b"), SCHEMA).selectExpr(
        "*", "1 as part", "2 as n", "3 as p1", "'x' as n_turns", "4 as _c", "5 as `a.b`")
    assert [r.conv_id for r in chat.format_chats(rows).collect()] == [2]


def test_plan_stays_native(spark):
    rows = spark.createDataFrame(turns(1, "a", "b"), SCHEMA)
    plan = chat.format_chats(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
