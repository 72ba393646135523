import json
import os
import tempfile

import pytest

from quarry.plans import jobs
from quarry.streaming import apps

MOVIES = ["1@Toy Story (1995)@Animation|Comedy", "2@(500) Days of Summer (2009)@Comedy|Drama",
          "3@Heat (1995)@Action", "4@Toy Story (1995)@Animation"]
RATINGS = ([f"{u}@1@5.0@0" for u in range(3)] + [f"{u}@2@4.0@0" for u in range(4)]
           + [f"{u}@3@2.0@0" for u in range(2)] + [f"{u}@4@3.0@0" for u in range(2)])


def _files():
    d = tempfile.mkdtemp()
    for name, lines in [("movies.dat", MOVIES), ("ratings.dat", RATINGS), ("tags.dat", ["1@1@fun@0"]),
                        ("book.txt", ["Ala ma kota", "kot ma Ale  ", ""])]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    return d


def test_word_count_and_genre_jobs(spark):
    d = _files()
    out = os.path.join(d, "wc")
    jobs.word_count_job(spark, os.path.join(d, "book.txt"), out)
    got = {(r[0] or ""): int(r[1]) for r in spark.read.csv(out).collect()}  # CSV reads "" back as null
    assert got == {"Ala": 1, "ma": 2, "kota": 1, "kot": 1, "Ale": 1, "": 1}
    g = {r.value: r["count"] for r in jobs.genre_ranking_job(spark, os.path.join(d, "movies.dat"),
                                                             os.path.join(d, "genres")).collect()}
    assert g == {"Animation": 2, "Comedy": 2, "Drama": 1, "Action": 1}


def test_movielens_reports(spark):
    d = _files()
    r = jobs.movielens_report(spark, os.path.join(d, "movies.dat"), os.path.join(d, "ratings.dat"),
                              min_votes=2)
    assert [tuple(x) for x in r["years"].collect()] == [(1995, 3), (500, 1)]
    best = [(x.title, x.votes) for x in r["best"].collect()]
    assert best == [("Toy Story (1995)", 5), ("(500) Days of Summer (2009)", 4)]
    s = jobs.movielens_sql_report(spark, os.path.join(d, "movies.dat"), os.path.join(d, "ratings.dat"),
                                  os.path.join(d, "tags.dat"), min_votes=0)
    assert spark.table("tags").first().tag == "fun"
    assert s["low_ratings"].count() == 0 and s["titles"].count() == 4
    assert {x.title: x.votes for x in s["best_sql"].collect()}["Heat (1995)"] == 2
    assert s["mean_with_movie"].count() == 4


def test_folder_and_landed_stream_jobs(spark):
    src = tempfile.mkdtemp()
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("a b a\nb\n")
    res = {r.word: r["count"] for r in apps.folder_word_count_job(spark, src).collect()}
    assert res == {"a": 2, "b": 2}
    landing = tempfile.mkdtemp()
    with open(os.path.join(landing, "m.json"), "w") as f:
        for i, m in enumerate(["x y", "y", "y z"]):
            f.write(json.dumps({"message_id": str(i), "message": m}) + "\n")
    got = [(r.word, r["count"]) for r in apps.landed_word_count_job(spark, landing).collect()]
    assert sorted(got) == [("x", 1), ("y", 3), ("z", 1)]


def test_kafka_jobs_need_the_connector(spark):
    d = tempfile.mkdtemp()
    with pytest.raises(Exception, match="(?i)kafka"):
        apps.kafka_word_count_job(spark, "localhost:9092", "t", "g", f"{d}/raw", f"{d}/counts", f"{d}/ck")


def test_audited_product_job_on_landed_binary_messages(spark):
    import base64

    from quarry.schemas import BINARY_MESSAGE
    from quarry.sources.streams import messages_stream
    from quarry.streaming.audit import read_audit
    landing = tempfile.mkdtemp()
    msgs = [{"creationDate": "01-02-2024 10:00:00", "id": i,
             "product": {"productName": f"p{i}", "color": "red", "material": None, "price": "9.99",
                         "promotionCode": None}} for i in range(5)]
    with open(os.path.join(landing, "m.json"), "w") as f:
        for i, m in enumerate(msgs):
            payload = base64.b64encode(json.dumps(m).encode()).decode()
            f.write(json.dumps({"message_id": str(i), "avro_data": payload}) + "\n")
    stream = messages_stream(spark, landing, schema=BINARY_MESSAGE).withColumnRenamed("avro_data", "value")
    data, audit = apps.audited_product_job(spark, stream, "products", "landing", landing, header_bytes=0)
    rows = spark.read.parquet(data).orderBy("id").collect()
    assert [r.productName for r in rows] == [f"p{i}" for i in range(5)] and rows[0].color == "red"
    running = [e for e in read_audit(spark, audit).collect() if e.event_type == "RUNNING"]
    assert sum(e.record_count for e in running) == 5
    assert ("price", "string") in [(f.name, f.type) for f in running[0].fields]
