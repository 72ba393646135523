import hashlib
import re

import pytest
from llm_helpers import tuples
from pyspark.sql import functions as F

from quarry.llm import queries, sketch
from quarry.session import table_path

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, n_chars, edited text) by a plain loop over sorted rows."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (d, t) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        out.append((d, len(t), t[:len(t) - half] + after[:half], t, after))
    return out


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(table_path(DIR, "documents")).select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op12_document_fingerprints(spark, DIR).collect()}
    off = []
    for d, n, edited, text, after in brute(rows):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        off += [abs(r.near_edited - jaccard(text, edited)), abs(r.near_next - jaccard(text, after))]
    assert len(got) == len(rows)
    assert sum(off) / len(off) < 0.03


def test_all_hashes_give_the_exact_similarity(spark):
    rows = [tuple(r) for r in spark.read.parquet(table_path(DIR, "documents")).select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in sketch.document_fingerprints(spark.createDataFrame(rows, DOCS), fraction=1).collect()}
    for d, _, edited, text, after in brute(rows):
        assert got[d].edited_text == edited
        assert got[d].near_edited == pytest.approx(jaccard(text, edited), abs=1e-12)
        assert got[d].near_next == pytest.approx(jaccard(text, after), abs=1e-12)


def test_sketches_merge_and_contain(spark):
    words = [f"w{i}" for i in range(4000)]
    docs = spark.createDataFrame([(1, " ".join(words[:400])), (2, " ".join(words)), (3, " ".join(words[396:]))], DOCS)
    s = docs.select("doc_id", sketch.word_hashes(F.col("text")).alias("w")).select("doc_id", sketch.sketch(F.col("w")).alias("s"))
    one = {r.doc_id: r.s for r in s.collect()}
    assert s.filter("doc_id <> 2").agg(sketch.merged(F.col("s")).alias("m")).first().m == one[2]
    assert 70 < len(one[1]) < 130 and 900 < len(one[2]) < 1100
    pair = spark.createDataFrame([(one[1], one[2])], "a array<long>, b array<long>")
    r = pair.select(sketch.containment(F.col("a"), F.col("b")), sketch.containment(F.col("b"), F.col("a"))).first()
    assert r[0] == 1 and 0.06 < r[1] < 0.15


def test_wrap_around_ties_and_short_texts(spark):
    rows = [(3, "ab"), (1, "x"), (2, ""), (None, "end of the list comes last"), (5, "éñ😀z"), (5, "éñ😀z"), (4, None)]
    got = tuples(sketch.document_fingerprints(spark.createDataFrame(rows, DOCS)).select(
        "doc_id", "edited_text", "near_edited", "n_chars"))
    assert got == [(1, "x", 1.0, 1), (2, "", 1.0, 0), (3, "a", 0.0, 2), (4, "", 1.0, 0), (5, "éñen", 0.0, 4),
                   (5, "éñen", 0.0, 4), (None, "end of the lix", 0.0, 26)]


def test_equal_texts_have_equal_fingerprints(spark):
    rows = [(i, t) for i, t in enumerate(["a b", "a b", "c", "one two three four five six seven"] * 3)]
    got = sketch.document_fingerprints(spark.createDataFrame(rows, DOCS)).select("text", "fingerprint").distinct()
    assert got.count() == 3 and got.select("fingerprint").distinct().count() == 3


def test_one_document_hostile_and_empty(spark, hostile, no_documents):
    one = sketch.document_fingerprints(spark.createDataFrame([(7, "abcd")], DOCS)).first()
    assert (one.edited_text, one.near_next) == ("abab", 1.0)
    got = sketch.document_fingerprints(hostile).collect()
    assert len(got) == 10 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sketch.document_fingerprints(no_documents).collect() == []
    with pytest.raises(ValueError):
        sketch.sketch(F.col("w"), fraction=0)


def test_many_ranges_give_the_same_order(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    got = sketch.followers(sketch._keyed(docs)).select(F.col("to.key"), "key").collect()
    assert sorted(map(tuple, got)) == sorted([(i, i + 1) for i in range(499)] + [(499, 0)])


def test_plan_stays_native(spark):
    df = queries.op12_document_fingerprints(spark, DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_texts_are_shuffled_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries.op12_document_fingerprints(spark, DIR)
        plan = df._jdf.queryExecution()
        df._jdf.collectToPython()
        assert "ReusedExchange" in plan.executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
