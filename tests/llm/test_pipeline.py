import duckdb
import pytest

import corpus_pipeline
from quarry.llm import queries
from quarry.session import work_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def planted(spark):
    """A folder of tables with a clean document, a copy, a near copy, a leak,
    a repeated line and an unusable row."""
    def words(tag, n):
        return " ".join(f"{tag}{i} the" for i in range(n))

    base, item = words("alpha", 60), words("item", 20)
    near = base.replace("alpha30", "changed")
    line = "This line stands in several of the documents."
    rows = [(1, base, "en", "s", 1), (2, base, "en", "s", 1), (3, near, "en", "s", 1),
            (4, words("gamma", 40) + " " + item + " " + words("delta", 40), "en", "s", 1),
            (5, words("clean", 50) + "\n" + line, "en", "s", 1), (6, line + "\n" + words("other", 50), "en", "s", 1),
            (7, None, "en", "s", 1), (8, "*** 123", "en", "s", 1), (9, words("last", 70), "en", "s", 1)]
    path = work_path(spark, "planted")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(0, "http://a.example.com/en/1", '<html lang="en"><p>the alpha the other</p>')],
                          "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


def test_stages_decide(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, planted)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        path = work_path(spark, "step")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        left[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(left["language_id"]) == {1, 2, 3, 4, 5, 6, 9}
    assert set(left["line_dedup"]) == {1, 4, 5, 6, 9}  # 3 is one line, near that of 1
    assert "\n" in left["line_dedup"][5] and "\n" not in left["line_dedup"][6]
    assert set(left["ngram_jaccard"]) == {1, 4, 5, 6, 9}
    assert set(left["decontamination"]) == {1, 5, 6, 9}
    packed = corpus_pipeline.run(spark, planted).collect()
    assert {r.doc_id for r in packed} == {1, 5, 6, 9} and {r.sequence_id for r in packed} == {0}


def tables(spark, docs):
    path = work_path(spark, "tables")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, "a benchmark item of some seven words"), (None, None), (1, "")],
                          "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(0, None, None), (None, "http://b.example.org", "<p>text and long text of its own kind</p>")],
                          "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


def test_run_on_hostile_rows(spark, hostile):
    """Rows without text, id or language, ties, repeats, a very long text and
    columns that clash with the operators' own."""
    packed = corpus_pipeline.run(spark, tables(spark, hostile)).collect()
    assert {r.doc_id for r in packed} <= {None, 5, 6, 7, 8, 9}
    assert sum(r.doc_id in (5, 6) for r in packed) <= 1 and sum(r.doc_id == 7 for r in packed) <= 2


def test_run_on_empty_tables(spark, no_documents):
    path = work_path(spark, "none")
    no_documents.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


def test_without_repeats_on_hostile_rows(spark, hostile, no_documents):
    from quarry.llm import lines
    left = lines.without_repeats(hostile)
    assert left.columns == hostile.columns
    texts = sorted(((r.doc_id or -1, r.text) for r in left.collect()), key=str)
    assert [t for d, t in texts if d == 1] == [None] and [t for d, t in texts if d == 2] == [""]
    assert [d for d, t in texts if t and t.startswith("tie")] == [5]
    assert sum(t is not None and t.startswith("same row") for _, t in texts) == 2
    assert lines.without_repeats(no_documents).collect() == []


def test_names():
    numbers = [int(x[2:].split("_")[0]) for x in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    import __spark_entry__
    assert "pipeline" in __spark_entry__.queries() and set(queries.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
