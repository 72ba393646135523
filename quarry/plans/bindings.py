"""Every operator bound to the driver tables: ``QUERIES[name](spark, sf_dir)``
returns a DataFrame, ``ORACLE_SQL[name]`` is the same question in plain SQL
(DuckDB dialect) over the same tables, for an independent check.

MovieLens roles on the driver tables:
  item / movie   = ``part``      (``p_partkey`` id, ``p_name`` title)
  rating         = ``lineitem``  (``l_suppkey`` user, ``l_partkey`` item,
                                  ``l_quantity`` rating)
  book lines     = every line of every ``documents.text``
  movie line     = ``id@title (p_size)@name words joined by |``
  messages       = ``events``    (``event_id`` message id)
Computed doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.functions.text import token_count
from quarry.plans import catalog, composed
from quarry.schemas import MOVIE, MOVIE_STRINGS, PRODUCT_MESSAGE, RATING, SCHEMA_CATALOG
from quarry.sources.files import parse_records, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- shared parts

def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


def _ratings(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("userId"), F.col("l_partkey").alias("movieId"),
        F.col("l_quantity").alias("rating"))


def _shifted_ratings(spark, sf_dir):
    """All ratings, of items 50 keys further on: the first 50 items are
    unrated, and the ratings of the last 50 belong to no item."""
    return _t(spark, sf_dir, "lineitem").select((F.col("l_partkey") + 50).alias("l_partkey"), "l_quantity")


def _lines(spark, sf_dir, keep=("doc_id",), with_position=False, spread=True):
    docs = _t(spark, sf_dir, "documents").select(*keep, "text")
    if spread:  # tokenising is CPU-heavy; give it all cores
        docs = op.spread(docs)
    return composed.text_lines(docs, "text", list(keep), with_position=with_position)


def _movie_lines(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    line = F.concat_ws("@", F.col("p_partkey").cast("string"),
                       F.concat(F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(")")),
                       F.regexp_replace("p_name", " ", "|"))
    return p.select(line.alias("value"))


_SQL_N = "replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
#: lines as a file reader gives them: any line end, no piece after the last one
SQL_SPLIT = (f"string_split(CASE WHEN ends_with({_SQL_N}, chr(10)) THEN left({_SQL_N}, len({_SQL_N}) - 1) "
             f"ELSE {_SQL_N} END, chr(10))")
SQL_LINES = f"SELECT doc_id, unnest({SQL_SPLIT}) AS value FROM documents"
SQL_JVM_WORDS = ("unnest(CASE WHEN value = '' THEN [''] WHEN rtrim(value, ' ') = '' "
                 "THEN []::VARCHAR[] ELSE string_split(rtrim(value, ' '), ' ') END)")
SQL_MOVIE_LINES = ("SELECT concat_ws('@', CAST(p_partkey AS VARCHAR), p_name || ' (' || "
                   "CAST(p_size AS VARCHAR) || ')', replace(p_name, ' ', '|')) AS value FROM part")


def _r6(c):
    return F.round(c, 6)


# ------------------------------------------------------- B: composed queries

@query("best_rated_inner", """
SELECT p_name AS title, count(*) AS votes,
       round(sum(l_quantity) / count(l_quantity), 6) AS rate
FROM part JOIN lineitem ON p_partkey = l_partkey
GROUP BY p_name HAVING count(*) > 100
ORDER BY sum(l_quantity) / count(l_quantity) DESC, p_name
LIMIT 10
""")
def best_rated_inner(spark, sf_dir):
    """B4 J1 A6 A16 O1 O4."""
    r = composed.best_rated(_t(spark, sf_dir, "part"), _t(spark, sf_dir, "lineitem"),
                             item_key="p_partkey", title="p_name", rating_item_key="l_partkey",
                             rating="l_quantity", min_votes=100, how="inner", top=10)
    return r.select("title", "votes", _r6(F.col("rate")).alias("rate"))


@query("best_rated_left", """
SELECT m.p_name AS title, count(*) AS votes, round(avg(r.l_quantity), 6) AS rate
FROM part m LEFT JOIN lineitem r ON m.p_partkey = r.l_partkey + 50
GROUP BY m.p_name HAVING count(*) > 100
""")
def best_rated_left(spark, sf_dir):
    """SQL form over views; rating keys are shifted by 50 against
    the items', so some items are unrated and the left join matters."""
    catalog.register_views(spark, movies=_t(spark, sf_dir, "part"), ratings=_shifted_ratings(spark, sf_dir))
    r = catalog.best_rated_sql(spark, "movies", "ratings", "p_partkey", "p_name",
                               "l_partkey", "l_quantity", min_votes=100)
    return r.select("title", "votes", _r6(F.col("rate")).alias("rate"))


@query("best_rated_left_df", """
SELECT m.p_name AS title, count(*) AS votes, round(avg(r.l_quantity), 6) AS rate
FROM part m LEFT JOIN lineitem r ON m.p_partkey = r.l_partkey + 50
GROUP BY m.p_name HAVING count(*) > 100
""")
def best_rated_left_df(spark, sf_dir):
    """B5 through the DataFrame API (``how="left"``)."""
    r = composed.best_rated(_t(spark, sf_dir, "part"),
                             _shifted_ratings(spark, sf_dir),
                             item_key="p_partkey", title="p_name", rating_item_key="l_partkey",
                             rating="l_quantity", min_votes=100, how="left", top=None)
    return r.select("title", "votes", _r6(F.col("rate")).alias("rate"))


@query("mean_with_attributes", """
SELECT p.p_partkey, round(a.avg_rating, 6) AS avg_rating, p.p_name, p.p_brand, p.p_type, p.p_size
FROM (SELECT l_partkey, avg(l_quantity) AS avg_rating FROM lineitem GROUP BY l_partkey) a
JOIN part p ON a.l_partkey = p.p_partkey
""")
def mean_with_attributes(spark, sf_dir):
    """B6 A4 J2."""
    r = composed.mean_with_attributes(
        _t(spark, sf_dir, "lineitem"),
        _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"),
        key="p_partkey", rating="l_quantity", rating_key="l_partkey")
    return r.select("p_partkey", _r6(F.col("avg_rating")).alias("avg_rating"),
                    "p_name", "p_brand", "p_type", "p_size")


@query("word_count", f"""
SELECT word, count(*) AS count
FROM (SELECT {SQL_JVM_WORDS} AS word FROM ({SQL_LINES}))
GROUP BY word
""")
def word_count(spark, sf_dir):
    """Every word of every line, Java-split semantics."""
    return composed.word_count(_lines(spark, sf_dir, keep=()), "value")


@query("word_count_nonempty", f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(string_split(value, ' ')) AS word FROM ({SQL_LINES}))
WHERE word <> ''
GROUP BY word
""")
def word_count_nonempty(spark, sf_dir):
    """B1 variant P20 P18: SQL split, empty words dropped."""
    return composed.word_count(_lines(spark, sf_dir, keep=()), "value", drop_empty=True,
                                java_split=False)


@query("genre_ranking", f"""
SELECT value, count(*) AS count
FROM (SELECT unnest(string_split(split_part(value, '@', 3), '|')) AS value FROM ({SQL_MOVIE_LINES}))
GROUP BY value
""")
def genre_ranking(spark, sf_dir):
    """Third field of the movie line, split on '|', ranked."""
    return composed.count_multivalued(_movie_lines(spark, sf_dir), "value", sep="|",
                                       field_index=2, field_sep="@")


@query("name_word_ranking", """
SELECT value, count(*) AS count
FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part)
GROUP BY value
""")
def name_word_ranking(spark, sf_dir):
    """B2 on a plain multi-valued column (space separated names)."""
    return composed.count_multivalued(_t(spark, sf_dir, "part"), "p_name", sep=" ")


@query("by_pattern", f"""
SELECT CAST(y AS INTEGER) AS year, count(*) AS count
FROM (SELECT regexp_extract(value, '\\(([0-9]+)\\)', 1) AS y FROM ({SQL_MOVIE_LINES}))
WHERE y <> ''
GROUP BY CAST(y AS INTEGER)
ORDER BY count DESC, year
LIMIT 10
""")
def by_pattern(spark, sf_dir):
    """Lines per first ``(digits)`` match, ten most frequent."""
    return composed.count_by_pattern(_movie_lines(spark, sf_dir), "value", top=10)


# ----------------------------------------------- S/P: parsing and expressions

@query("parse_records", """
SELECT CAST(l_suppkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
       l_quantity AS rating, l_linenumber AS timestamp
FROM lineitem
""")
def parse_records_q(spark, sf_dir):
    """``user@item@rating@ts`` lines parsed back to typed records."""
    li = _t(spark, sf_dir, "lineitem")
    lines = li.select(F.concat_ws("@", F.col("l_suppkey").cast("string"),
                                  F.col("l_partkey").cast("string"),
                                  F.col("l_quantity").cast("string"),
                                  F.col("l_linenumber").cast("string")).alias("value"))
    return parse_records(lines, RATING, sep="@", mode="failfast")


@query("delimited_roundtrip", """
SELECT CAST(p_partkey AS INTEGER) AS movieId,
       CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || p_name || ' '
            WHEN 3 THEN p_name || chr(10) || 'next' WHEN 4 THEN 'a@b"c"' || p_name WHEN 5 THEN p_name || chr(13)
            WHEN 6 THEN chr(92) || p_name || chr(92) ELSE p_name END AS title,
       p_type AS genres FROM part
""")
def delimited_roundtrip(spark, sf_dir):
    """K1 + S2 + P9: items, some with hostile titles (null, empty, blanks,
    line ends, separators, quotes, backslashes), written as header-less
    ``@``-delimited files and read back with a fixed schema."""
    from quarry.session import work_path
    from quarry.sources.files import read_delimited
    from quarry.sources.sinks import write_result
    name, k = F.col("p_name"), F.col("p_partkey") % 8
    title = (F.when(k == 0, F.lit(None)).when(k == 1, F.lit("")).when(k == 2, F.concat(F.lit(" "), name, F.lit(" ")))
             .when(k == 3, F.concat(name, F.lit("\nnext"))).when(k == 4, F.concat(F.lit('a@b"c"'), name))
             .when(k == 5, F.concat(name, F.lit("\r"))).when(k == 6, F.concat(F.lit("\\"), name, F.lit("\\"))).otherwise(name))
    folder = work_path(spark, "movies-dat")
    write_result(_t(spark, sf_dir, "part").select("p_partkey", title.alias("title"), "p_type"), folder,
                 fmt="csv", sep="@", header="false")
    return read_delimited(spark, folder, ["movieId", "title", "genres"], sep="@", schema=MOVIE, exact=True)


@query("text_file_word_count", f"""
SELECT word, count(*) AS count
FROM (SELECT {SQL_JVM_WORDS} AS word FROM ({SQL_LINES}))
GROUP BY word
""")
def text_file_word_count(spark, sf_dir):
    """S1 + B1: texts written as plain text files, read back line by line,
    Java-split word count."""
    from quarry.session import work_path
    from quarry.sources.files import read_lines
    folder = work_path(spark, "books")
    op.spread(_t(spark, sf_dir, "documents").select("text")).write.mode("overwrite").text(folder)
    return composed.word_count(read_lines(spark, folder))


@query("json_events", "SELECT event_id, user_id, event_type, value, props FROM events")
def json_events(spark, sf_dir):
    """Events written as JSON lines and read back with a fixed schema."""
    from quarry.session import work_path
    from quarry.sources.files import read_events
    folder = work_path(spark, "events-json")
    cols = ["event_id", "user_id", "event_type", "value", "props"]
    ev = _t(spark, sf_dir, "events").select(*cols)
    ev.write.mode("overwrite").json(folder)
    return read_events(spark, folder, ev.schema)


@query("project", "SELECT p_name AS title FROM part")
def project(spark, sf_dir):
    """P1."""
    return _t(spark, sf_dir, "part").select(F.col("p_name").alias("title"))


@query("project_plus_one", """
SELECT l_suppkey AS userId, l_partkey AS movieId, l_quantity + 1 AS rating_plus_one FROM lineitem
""")
def project_plus_one(spark, sf_dir):
    """P2 (outputs aliased, so the names do not depend on how they were spelled)."""
    r = _ratings(spark, sf_dir)
    return r.select("userId", "movieId", (F.col("rating") + 1).alias("rating_plus_one"))


@query("square", """
SELECT l_orderkey, l_linenumber, l_quantity * l_quantity AS squared FROM lineitem
""")
def square(spark, sf_dir):
    """P3."""
    return _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_quantity")).alias("squared"))


@query("label", "SELECT p_partkey, 'Movie: ' || p_name AS label FROM part")
def label(spark, sf_dir):
    """P4."""
    return _t(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("Movie: "), F.col("p_name")).alias("label"))


@query("value_pairs", """
SELECT l_suppkey AS key, l_quantity AS value, 1 AS one FROM lineitem
""")
def value_pairs(spark, sf_dir):
    """P5: value-only map ``v -> (v, 1)`` on (key, value) pairs."""
    pairs = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"),
                                                  F.col("l_quantity").alias("value"))
    return pairs.withColumn("pair", F.struct(F.col("value"), F.lit(1).alias("one"))).select(
        "key", "pair.value", "pair.one")


@query("token_counts", f"""
SELECT doc_id, line_no, value AS line,
       CAST(len(CASE WHEN value = '' THEN [''] WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]
           ELSE string_split(rtrim(value, ' '), ' ') END) AS INTEGER) AS n_tokens
FROM (SELECT doc_id, unnest({SQL_SPLIT}) AS value,
             unnest(range(len({SQL_SPLIT}))) AS line_no FROM documents)
""")
def token_counts(spark, sf_dir):
    """Every line with its token count."""
    lines = _lines(spark, sf_dir, with_position=True)
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"),
                        F.col("value").alias("line"), token_count("value").alias("n_tokens"))


@query("longest_line", f"""
SELECT CAST(max(len(CASE WHEN value = '' THEN [''] WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]
           ELSE string_split(rtrim(value, ' '), ' ') END)) AS INTEGER) AS max_tokens
FROM ({SQL_LINES})
""")
def longest_line(spark, sf_dir):
    """Most words on one line."""
    return op.global_max(_lines(spark, sf_dir, keep=()), token_count("value"), "max_tokens")


@query("numeric_filter", """
SELECT l_suppkey AS userId, l_partkey AS movieId, l_quantity AS rating FROM lineitem WHERE l_quantity < 2
""")
def numeric_filter(spark, sf_dir):
    """P15 (pushed into the parquet scan)."""
    return _ratings(spark, sf_dir).filter(F.col("rating") < 2)


@query("contains_filter", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def contains_filter(spark, sf_dir):
    """P16."""
    return _t(spark, sf_dir, "part").select("p_partkey", "p_name").filter(
        F.col("p_name").contains("ring"))


@query("conform", """
SELECT CAST(p_partkey AS VARCHAR) AS movieId, p_name AS title, p_type AS genres FROM part
""")
def conform(spark, sf_dir):
    """Conform to an all-string record schema (reorder + upcast)."""
    p = _t(spark, sf_dir, "part").select(F.col("p_type").alias("genres"),
                                         F.col("p_name").alias("title"),
                                         F.col("p_partkey").alias("movieId"))
    return p.to(MOVIE_STRINGS)


@query("binary_to_text", "SELECT event_id, event_type AS message FROM events")
def binary_to_text(spark, sf_dir):
    """P10: binary payload cast to text."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.encode("event_type", "UTF-8").alias("value"))
    return ev.select("event_id", F.col("value").cast("string").alias("message"))


@query("strip_header", "SELECT event_id, props AS message FROM events")
def strip_header_q(spark, sf_dir):
    """5-byte wire header removed from a binary payload."""
    from quarry.functions.binary import strip_header
    framed = F.concat(F.unhex(F.lit("0000000001")), F.encode("props", "UTF-8"))
    ev = _t(spark, sf_dir, "events").select("event_id", framed.alias("value"))
    return ev.select("event_id", strip_header("value").cast("string").alias("message"))


@query("payload_json", "SELECT event_id, CAST(props::JSON ->> 'k' AS INTEGER) AS k FROM events")
def payload_json(spark, sf_dir):
    """JSON payload decoded with a fixed schema."""
    from quarry.functions.binary import decode_payload
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", decode_payload("props", "k int").alias("m")).select("event_id", "m.k")


def _product_json(ev: DataFrame) -> DataFrame:
    msg = F.struct(
        F.date_format("ts", "dd-MM-yyyy HH:mm:ss").alias("creationDate"),
        F.col("event_id").alias("id"),
        F.struct(F.col("event_type").alias("productName"), F.col("props").alias("color"),
                 F.lit(None).cast("string").alias("material"),
                 F.col("value").cast("string").alias("price"),
                 F.col("user_id").cast("string").alias("promotionCode")).alias("product"))
    return ev.select(F.col("event_id").cast("string").alias("message_id"),
                     F.to_json(msg).alias("payload"))


SQL_PRODUCT = """
SELECT CAST(event_id AS VARCHAR) AS message_id, strftime(ts, '%d-%m-%Y %H:%M:%S') AS creationDate,
       event_id AS id, event_type AS productName, props AS color, CAST(NULL AS VARCHAR) AS material,
       CAST(value AS VARCHAR) AS price, CAST(user_id AS VARCHAR) AS promotionCode
FROM events
"""


@query("product_flat", SQL_PRODUCT)
def product_flat(spark, sf_dir):
    """Nested product message decoded and flattened."""
    from quarry.functions.binary import decode_payload
    from quarry.functions.nested import flatten_struct
    msgs = _product_json(op.spread(_t(spark, sf_dir, "events")))  # JSON work is CPU-heavy
    dec = msgs.select("message_id", decode_payload("payload", PRODUCT_MESSAGE).alias("m"))
    return flatten_struct(dec, "m", keep=["message_id"])


# a product message's schema in two versions: the second widens id and price,
# drops the promotion code and adds a rating and a channel
_PRODUCT_V1 = {"type": "record", "name": "Message", "fields": [
    {"name": "creationDate", "type": ["null", "string"]}, {"name": "id", "type": ["null", "int"]},
    {"name": "product", "type": ["null", {"type": "record", "name": "Product", "fields": [
        {"name": "productName", "type": ["null", "string"]}, {"name": "color", "type": ["null", "string"]},
        {"name": "price", "type": ["null", "int"]}, {"name": "promotionCode", "type": ["null", "string"]}]}]}]}
_PRODUCT_V2 = {"type": "record", "name": "Message", "fields": [
    {"name": "creationDate", "type": ["null", "string"]}, {"name": "id", "type": ["null", "long"]},
    {"name": "product", "type": ["null", {"type": "record", "name": "Product", "fields": [
        {"name": "productName", "type": ["null", "string"]}, {"name": "color", "type": ["null", "string"]},
        {"name": "price", "type": ["null", "double"]}, {"name": "rating", "type": ["null", "double"]}]}]},
    {"name": "channel", "type": ["null", "string"]}]}


def _product_catalog(spark):
    import json
    return spark.createDataFrame([("product-value", 101, 1, "AVRO", json.dumps(_PRODUCT_V1)),
                                  ("product-value", 258, 2, "AVRO", json.dumps(_PRODUCT_V2)),
                                  ("other-value", 9, 1, "AVRO", '"string"')], SCHEMA_CATALOG)


def _framed_products(ev: DataFrame) -> DataFrame:
    """One framed message per event: version 1, version 2, and every third
    one with something wrong."""
    from quarry.lineage.writers import frame
    name, day = F.col("event_type").alias("productName"), F.date_format("ts", "dd-MM-yyyy HH:mm:ss").alias("creationDate")
    eid, color = F.col("event_id"), F.col("props").alias("color")
    v1 = F.to_json(F.struct(day, eid.cast("int").alias("id"), F.struct(
        name, color, F.floor("value").cast("int").alias("price"), F.col("user_id").cast("string").alias("promotionCode")).alias("product")))
    v2 = F.to_json(F.struct(day, (eid + 5_000_000_000).alias("id"), F.struct(
        name, color, F.col("value").alias("price"), (F.col("user_id") / 4).alias("rating")).alias("product"),
        F.lit("web").alias("channel")))
    kind = F.pmod(eid, F.lit(12))
    payload = F.encode(F.when(F.pmod(eid, F.lit(3)) == 0, v1).otherwise(v2), "UTF-8")
    sid = F.when(F.pmod(eid, F.lit(3)) == 0, 101).when(kind == 8, 999).otherwise(258)
    value = (F.when(kind == 2, F.encode(F.lit("abc"), "UTF-8")).when(kind == 5, frame(F.encode(F.lit('{"id": '), "UTF-8"), F.lit(258)))
             .when(kind == 11, F.lit(None).cast("binary")).otherwise(frame(payload, sid)))
    return ev.select(eid.cast("string").alias("message_id"), value.alias("value"))


@query("product_versions", """
SELECT CAST(event_id AS VARCHAR) AS message_id, 1 AS schema_version, strftime(ts, '%d-%m-%Y %H:%M:%S') AS creationDate,
       event_id AS id, event_type AS productName, props AS color, CAST(floor(value) AS DOUBLE) AS price,
       CAST(user_id AS VARCHAR) AS promotionCode, CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS VARCHAR) AS channel
FROM events WHERE event_id % 3 = 0
UNION ALL
SELECT CAST(event_id AS VARCHAR), 2, strftime(ts, '%d-%m-%Y %H:%M:%S'), event_id + 5000000000, event_type, props, value,
       NULL, user_id / 4.0, 'web'
FROM events WHERE event_id % 3 = 1
""")
def product_versions(spark, sf_dir):
    """Messages of two schema versions in one table, each decoded
    by the id in its header; what can't be is left out."""
    from quarry.lineage.writers import accepted, decode_by_writer, live_writers
    framed = _framed_products(op.spread(_t(spark, sf_dir, "events")))
    writers = live_writers(_product_catalog(spark), ["product-value"])
    return accepted(decode_by_writer(framed, writers, keep=["message_id"]), ["message_id"])


@query("product_rejects", """
SELECT CASE event_id % 12 WHEN 2 THEN 'no header' WHEN 5 THEN 'malformed payload' WHEN 8 THEN 'unknown schema id'
       ELSE 'no payload' END AS reject, CAST(CASE event_id % 12 WHEN 5 THEN 258 WHEN 8 THEN 999 END AS BIGINT) AS schema_id, count(*) AS n
FROM events WHERE event_id % 3 = 2 GROUP BY ALL
""")
def product_rejects(spark, sf_dir):
    """What the reject table holds, by reason and schema id."""
    from quarry.lineage.writers import decode_by_writer, live_writers, rejected
    framed = _framed_products(op.spread(_t(spark, sf_dir, "events")))
    writers = live_writers(_product_catalog(spark), ["product-value"])
    return rejected(decode_by_writer(framed, writers)).groupBy("reject", "schema_id").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------- J: joins

@query("inner_join", """
SELECT l_orderkey, l_linenumber, p_name, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def inner_join(spark, sf_dir):
    """J1."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                              F.col("l_partkey").alias("p_partkey"), "l_quantity")
    return op.join_by_key(li, _t(spark, sf_dir, "part").select("p_partkey", "p_name"),
                          "p_partkey").select("l_orderkey", "l_linenumber", "p_name", "l_quantity")


@query("left_join", """
SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey + 100
""")
def left_join(spark, sf_dir):
    """Customers with the orders of the customer 100 keys before, or null
    (the shift leaves customers without orders). Hot customers are split."""
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    o = _t(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).alias("c_custkey"), "o_orderkey")
    return op.join_split(c, o, "c_custkey", "left")


@query("bucketed_join", """
SELECT l_orderkey, l_linenumber, p_name, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def bucketed_join(spark, sf_dir):
    """J1 J2 on tables bucketed and sorted by the key: no shuffle in the join."""
    import uuid

    from quarry.session import work_path
    from quarry.sources.sinks import write_bucketed
    run, buckets = uuid.uuid4().hex[:12], int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), "l_quantity")
    sides = [write_bucketed(df, f"quarry_{name}_{run}", ["p_partkey"], buckets, work_path(spark, f"bucketed-{name}"))
             for name, df in (("lineitem", li), ("part", _t(spark, sf_dir, "part").select("p_partkey", "p_name")))]
    return op.join_by_key(sides[0], sides[1], "p_partkey", strategy="merge").select("l_orderkey", "l_linenumber", "p_name", "l_quantity")


@query("right_join", """
SELECT l.l_orderkey, l.l_linenumber, p.p_partkey, p.p_name
FROM part p RIGHT JOIN lineitem l ON p.p_partkey = l.l_partkey + 50
""")
def right_join(spark, sf_dir):
    """Every line item, with the part 50 keys further on if there is one."""
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") + 50).alias("_key"))
    return p.join(li, p["p_partkey"] == li["_key"], "right").select(
        "l_orderkey", "l_linenumber", "p_partkey", "p_name")


def _sql_chunks(table: str, key: str, value: str, size: int) -> str:
    """Sorted values of each key in lists of ``size``."""
    return (f"SELECT key, chunk, string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) AS s FROM ("
            f"SELECT {key} AS key, {value} AS v, "
            f"(row_number() OVER (PARTITION BY {key} ORDER BY {value}) - 1) // {size} AS chunk FROM {table}) "
            f"GROUP BY key, chunk")


def _sql_cogroup(size: int) -> str:
    return f"""
WITH lg AS ({_sql_chunks("(SELECT p_partkey + 50 AS k, p_size FROM part)", "k", "p_size", size)}),
     rg AS ({_sql_chunks("lineitem", "l_partkey", "l_quantity", size)})
SELECT coalesce(lg.key, rg.key) AS key, coalesce(lg.chunk, rg.chunk) AS chunk,
       coalesce(lg.s, '') AS left_values, coalesce(rg.s, '') AS right_values
FROM lg FULL OUTER JOIN rg ON lg.key = rg.key AND lg.chunk = rg.chunk
"""


def _joined(c: str):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def _cogroup(spark, sf_dir, size):
    left = _t(spark, sf_dir, "part").select((F.col("p_partkey") + 50).alias("key"), F.col("p_size").alias("v"))
    right = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_quantity").alias("v"))
    return op.cogroup(left, right, "key", "v", "v", chunk_rows=size).select(
        "key", "chunk", _joined("left").alias("left_values"), _joined("right").alias("right_values"))


@query("cogroup", _sql_cogroup(100_000))
def cogroup_q(spark, sf_dir):
    """parts' sizes and items' ratings per key; part keys are shifted by
    50, so either side lacks keys of the other."""
    return _cogroup(spark, sf_dir, 100_000)


@query("cogroup_chunked", _sql_cogroup(7))
def cogroup_chunked(spark, sf_dir):
    """J5 with lists of seven values: many chunks per key."""
    return _cogroup(spark, sf_dir, 7)


@query("composite_join", """
SELECT l.l_orderkey, l.l_linenumber, round(p.prediction, 6) AS prediction
FROM lineitem l JOIN (SELECT l_suppkey, l_partkey, avg(l_quantity) AS prediction
                      FROM lineitem GROUP BY l_suppkey, l_partkey) p
  ON l.l_suppkey = p.l_suppkey AND l.l_partkey = p.l_partkey
""")
def composite_join(spark, sf_dir):
    """Per (user, item) predictions joined back on both keys; hot pairs
    are split."""
    li = _t(spark, sf_dir, "lineitem")
    pred = li.groupBy("l_suppkey", "l_partkey").agg(F.avg("l_quantity").alias("prediction"))
    return op.join_split(pred, li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"),
                         ["l_suppkey", "l_partkey"]).select(
        "l_orderkey", "l_linenumber", _r6(F.col("prediction")).alias("prediction"))


# ------------------------------------------------------------ A: aggregates

@query("count_all", "SELECT count(*) AS count FROM lineitem")
def count_all(spark, sf_dir):
    """A1."""
    return op.count_rows(_t(spark, sf_dir, "lineitem"))


@query("count_if_two", f"""
SELECT count(*) FILTER (WHERE contains(value, 'a')) AS lines_with_a,
       count(*) FILTER (WHERE contains(value, 'b')) AS lines_with_b
FROM ({SQL_LINES})
""")
def count_if_two(spark, sf_dir):
    """A2: two predicate counts in one pass over all lines."""
    return op.count_where(_lines(spark, sf_dir, keep=(), spread=False),
                          lines_with_a=F.col("value").contains("a"),
                          lines_with_b=F.col("value").contains("b"))


@query("group_count", "SELECT l_partkey AS movieId, count(*) AS count FROM lineitem GROUP BY l_partkey")
def group_count(spark, sf_dir):
    """A3."""
    return op.group_count(_ratings(spark, sf_dir), "movieId")


@query("group_mean", """
SELECT l_partkey AS movieId, round(avg(l_quantity), 6) AS avg_rating FROM lineitem GROUP BY l_partkey
""")
def group_mean(spark, sf_dir):
    """A4."""
    r = op.group_mean(_ratings(spark, sf_dir), "movieId", "rating", "avg_rating")
    return r.select("movieId", _r6(F.col("avg_rating")).alias("avg_rating"))


@query("sum_by_key", "SELECT l_suppkey AS userId, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey")
def sum_by_key(spark, sf_dir):
    """A5."""
    return op.sum_by_key(_ratings(spark, sf_dir), "userId", "rating")


@query("mean_by_key", """
SELECT l_suppkey AS userId, round(sum(l_quantity) / count(l_quantity), 6) AS mean
FROM lineitem GROUP BY l_suppkey
""")
def mean_by_key(spark, sf_dir):
    """A6."""
    r = op.mean_by_key(_ratings(spark, sf_dir), "userId", "rating")
    return r.select("userId", _r6(F.col("mean")).alias("mean"))


def _sql_collect(size: int) -> str:
    return f"SELECT key AS userId, chunk, s AS ratings FROM ({_sql_chunks('lineitem', 'l_suppkey', 'l_quantity', size)})"


def _collect(spark, sf_dir, size):
    g = op.collect_by_key(_ratings(spark, sf_dir).select("userId", "rating"), "userId", "rating", out="ratings",
                          chunk_rows=size)
    return g.select("userId", "chunk", _joined("ratings").alias("ratings"))


@query("collect_by_key", _sql_collect(100_000))
def collect_by_key(spark, sf_dir):
    """A user's ratings as sorted lists."""
    return _collect(spark, sf_dir, 100_000)


@query("collect_chunked", _sql_collect(11))
def collect_chunked(spark, sf_dir):
    """A7 with lists of eleven values."""
    return _collect(spark, sf_dir, 11)


@query("count_by_key", "SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey")
def count_by_key(spark, sf_dir):
    """A8 (result stays distributed)."""
    return op.count_by_key(_t(spark, sf_dir, "orders"), "o_custkey")


@query("count_by_value", "SELECT l_quantity AS rating, count(*) AS count FROM lineitem GROUP BY l_quantity")
def count_by_value(spark, sf_dir):
    """A9."""
    return op.count_by_value(_ratings(spark, sf_dir), "rating")


@query("sum_reduce", "SELECT sum(l_quantity) AS total FROM lineitem")
def sum_reduce(spark, sf_dir):
    """A10."""
    return op.total(_t(spark, sf_dir, "lineitem"), "l_quantity")


@query("sum_fold", "SELECT CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS total FROM lineitem")
def sum_fold(spark, sf_dir):
    """Fold from zero (an empty input gives 0, not null); integer sum,
    exact in any summation order."""
    return op.total(_t(spark, sf_dir, "lineitem"), "l_linenumber", zero=0)


@query("sum_count_mean", """
SELECT sum(l_quantity) AS total, count(l_quantity) AS count, round(sum(l_quantity) / count(l_quantity), 6) AS mean
FROM lineitem
""")
def sum_count_mean(spark, sf_dir):
    """A12."""
    r = op.sum_count_mean(_t(spark, sf_dir, "lineitem"), "l_quantity")
    return r.select("total", "count", _r6(F.col("mean")).alias("mean"))


@query("group_by_expr", """
SELECT substring(p_name, 1, 1) AS initial, count(*) AS count FROM part GROUP BY substring(p_name, 1, 1)
""")
def group_by_expr(spark, sf_dir):
    """Group by a computed key, aliased."""
    return op.group_count(_t(spark, sf_dir, "part"), F.substring("p_name", 1, 1).alias("initial"))


@query("distinct", "SELECT DISTINCT l_quantity FROM lineitem")
def distinct(spark, sf_dir):
    """A15."""
    return op.distinct_values(_t(spark, sf_dir, "lineitem"), "l_quantity")


@query("distinct_words", f"""
SELECT count(DISTINCT word) AS distinct_keys
FROM (SELECT unnest(string_split(value, ' ')) AS word FROM ({SQL_LINES})) WHERE word <> ''
""")
def distinct_words(spark, sf_dir):
    """A17 (batch form): number of distinct non-empty words."""
    w = composed.words(_lines(spark, sf_dir, keep=()), drop_empty=True, java_split=False)
    return op.distinct_key_count(w, "word")


@query("mse", """
SELECT round(avg((l.l_quantity - p.pred) * (l.l_quantity - p.pred)), 6) AS mse
FROM lineitem l JOIN (SELECT l_partkey, avg(l_quantity) AS pred FROM lineitem GROUP BY l_partkey) p
  ON l.l_partkey = p.l_partkey
""")
def mse(spark, sf_dir):
    """Item mean as prediction, mean squared error over all ratings;
    hot items are split."""
    li = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_orderkey")
    pred = li.groupBy("l_partkey").agg(F.avg("l_quantity").alias("pred"))
    return op.mean_squared_error(op.join_split(pred, li, "l_partkey"), "l_quantity", "pred").select(
        _r6(F.col("mse")).alias("mse"))


# -------------------------------------------------------- O: order and top-k

@query("sort_desc", """
SELECT l_suppkey AS userId, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey
ORDER BY total DESC, userId
""")
def sort_desc(spark, sf_dir):
    """O1: totals by value, descending, deterministic ties."""
    return op.sort_by(op.sum_by_key(_ratings(spark, sf_dir), "userId", "rating"),
                      "total", False, tie_break="userId")


@query("sort_key", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey")
def sort_key(spark, sf_dir):
    """O2."""
    return op.sort_by(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")


@query("first_n", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 10")
def first_n(spark, sf_dir):
    """O4."""
    return op.top_n(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), 10, "p_partkey", True)


@query("first_row", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1")
def first_row(spark, sf_dir):
    """O5."""
    return op.first_row(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                        "o_orderkey")


@query("top_n", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 3
""")
def top_n(spark, sf_dir):
    """Three largest."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return op.top_n(li, 3, "l_extendedprice", False, tie_break=["l_orderkey", "l_linenumber"])


@query("smallest_n", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT 3
""")
def smallest_n(spark, sf_dir):
    """Three smallest."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return op.top_n(li, 3, "l_extendedprice", True, tie_break=["l_orderkey", "l_linenumber"])


@query("top_by_count", """
SELECT l_partkey AS movieId, count(*) AS count FROM lineitem GROUP BY l_partkey
ORDER BY count DESC, movieId LIMIT 10
""")
def top_by_count(spark, sf_dir):
    """N keys by a custom ordering (count descending)."""
    return op.top_n(op.group_count(_ratings(spark, sf_dir), "movieId"), 10, "count", False,
                    tie_break="movieId")


# --------------------------------------------------------- U: set operations

def _set_sides(spark, sf_dir):
    a = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"))
    b = _t(spark, sf_dir, "part").select((F.col("p_partkey") + 50).alias("key"))
    return a, b


SQL_SET_A = "SELECT l_partkey AS key FROM lineitem"
SQL_SET_B = "SELECT p_partkey + 50 AS key FROM part"


@query("union_all", f"{SQL_SET_A} UNION ALL {SQL_SET_B}")
def union_all(spark, sf_dir):
    """U1."""
    return op.union_all(*_set_sides(spark, sf_dir))


@query("intersect", f"{SQL_SET_A} INTERSECT {SQL_SET_B}")
def intersect(spark, sf_dir):
    """U2."""
    return op.intersect_distinct(*_set_sides(spark, sf_dir))


@query("subtract_keep_dups", f"""
SELECT a.key FROM ({SQL_SET_A}) a
WHERE NOT EXISTS (SELECT 1 FROM ({SQL_SET_B}) b WHERE a.key IS NOT DISTINCT FROM b.key)
""")
def subtract_keep_dups(spark, sf_dir):
    """Line items whose key no shifted part has, duplicates kept."""
    return op.subtract_keep_dups(*_set_sides(spark, sf_dir))


@query("except_distinct", f"{SQL_SET_A} EXCEPT {SQL_SET_B}")
def except_distinct(spark, sf_dir):
    """U4."""
    return op.except_distinct(*_set_sides(spark, sf_dir))


# ------------------------------------------------------------- Q: SQL surface

@query("view_select", "SELECT * FROM part")
def view_select(spark, sf_dir):
    """Q1 Q3."""
    catalog.register_views(spark, movies=_t(spark, sf_dir, "part"))
    return catalog.select_all(spark, "movies")


@query("global_view", "SELECT * FROM part")
def global_view(spark, sf_dir):
    """Q2."""
    return catalog.register_global_view(spark, _t(spark, sf_dir, "part"), "gmovies")


@query("group_mean_sql", """
SELECT l_partkey AS movieId, round(avg(l_quantity), 6) AS rating FROM lineitem GROUP BY l_partkey
""")
def group_mean_sql(spark, sf_dir):
    """Q4."""
    catalog.register_views(spark, ratings=_t(spark, sf_dir, "lineitem"))
    r = catalog.mean_by_key_sql(spark, "ratings", "l_partkey", "l_quantity", key_alias="movieId", name="rating")
    return r.select("movieId", _r6(F.col("rating")).alias("rating"))


@query("sql_count_order", """
SELECT l_partkey AS movieId, count(*) AS counted FROM lineitem GROUP BY l_partkey ORDER BY counted DESC
""")
def sql_count_order(spark, sf_dir):
    """Q5."""
    catalog.register_views(spark, ratings=_t(spark, sf_dir, "lineitem"))
    return catalog.count_by_key_sql(spark, "ratings", "l_partkey", "movieId")


# ------------------------------------------------------- L: schema catalogue

@query("latest_version", """
SELECT user_id, event_id, ts, event_type
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_version(spark, sf_dir):
    """L3: latest entry per subject (user), by (ts, event_id)."""
    from quarry.lineage.catalog import latest_per_key
    return latest_per_key(_t(spark, sf_dir, "events"), "user_id", ["ts", "event_id"],
                          ["event_id", "ts", "event_type"])


# ---------------- X: sampling (what holds for any seed, over all rows)

def _flags(df: DataFrame, **checks) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in checks.items()])


@query("sample", """
SELECT count(*) AS n_rows, true AS each_once, true AS within_bounds, true AS same_elsewhere FROM lineitem
""")
def sample(spark, sf_dir):
    """Half of the line items, seeded. Every row comes once at most, the
    share is within six standard deviations of one half, and the table dealt
    to other partitions gives the same rows."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    s = op.sample_fraction(li, 0.5, seed=7).withColumn("taken", F.lit(1))
    again = op.sample_fraction(li.repartition(13, "l_linenumber", "l_orderkey"), 0.5, seed=7).withColumn("taken", F.lit(2))
    both = li.withColumn("taken", F.lit(0)).unionByName(s).unionByName(again).groupBy("l_orderkey", "l_linenumber").agg(
        *[F.count_if(F.col("taken") == k).alias(c) for k, c in enumerate(("rows", "taken", "again"))])
    t = both.agg(F.sum("rows").alias("n"), F.sum("taken").alias("k"), F.max(F.col("taken") - F.col("rows")).alias("over"),
                 F.every(F.col("taken") == F.col("again")).alias("same"))
    return _flags(t, n_rows=F.col("n"), each_once=F.col("over") <= 0,
                  within_bounds=F.abs(F.col("k") - F.col("n") / 2) <= 3 * F.sqrt("n"), same_elsewhere=F.col("same"))


@query("sample_n", "SELECT CAST(3 AS BIGINT) AS n_rows, true AS of_the_table")
def sample_n(spark, sf_dir):
    """Exactly three line items drawn with replacement, all of them the table's."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    s = op.sample_n_with_replacement(li, 3, seed=7)
    found = s.join(li.distinct().withColumn("here", F.lit(True)), ["l_orderkey", "l_linenumber"], "left")
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.every(F.coalesce("here", F.lit(False))).alias("of_the_table"))


@query("sample_many", """
SELECT CAST(40000 AS BIGINT) AS n_rows, true AS of_the_table, true AS multiplicity_within_bounds FROM lineitem LIMIT 1
""")
def sample_many(spark, sf_dir):
    """X2 with many draws: exactly 40,000 line items with replacement, all of
    the table, and pairs of equal draws within six standard deviations of
    their expected number."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    drawn = op.sample_n_with_replacement(li, 40_000, seed=11).withColumn("drawn", F.lit(1))
    t = li.withColumn("drawn", F.lit(0)).unionByName(drawn).groupBy("l_orderkey", "l_linenumber").agg(
        F.count_if(F.col("drawn") == 0).alias("rows"), F.sum("drawn").alias("times")).agg(
        F.sum("times").alias("n"), F.sum("rows").alias("all"), F.every((F.col("rows") > 0) | (F.col("times") == 0)).alias("own"),
        F.sum(F.col("times") * (F.col("times") - 1) / 2).alias("pairs"), F.sum(F.pow("rows", F.lit(2))).alias("sq"))
    expected = F.col("n") * (F.col("n") - 1) / 2 * F.col("sq") / F.pow("all", F.lit(2))
    return _flags(t, n_rows=F.col("n"), of_the_table=F.col("own"),
                  multiplicity_within_bounds=F.abs(F.col("pairs") - expected) <= 6 * F.sqrt(expected) + 1)


@query("split", """
SELECT count(*) AS n_rows, true AS complete_and_disjoint, true AS within_bounds, true AS same_elsewhere FROM lineitem
""")
def split(spark, sf_dir):
    """0.8 / 0.2 split, tagged: every row of the table in one part, which
    is the same one when the table is dealt to other partitions."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    parts = op.tagged_split(li, [0.8, 0.2], seed=7)
    again = op.tagged_split(li.repartition(13, "l_linenumber", "l_orderkey"), [0.8, 0.2], seed=7).withColumn("split", F.col("split") + 2)
    both = li.withColumn("split", F.lit(-1)).unionByName(parts).unionByName(again).groupBy("l_orderkey", "l_linenumber").agg(
        F.count_if(F.col("split") < 0).alias("rows"), F.count_if(F.col("split").between(0, 1)).alias("dealt"),
        F.count_if(F.col("split") == 1).alias("second"), F.count_if(F.col("split") == 3).alias("second_again"))
    t = both.agg(F.sum("rows").alias("n"), F.every(F.col("rows") == F.col("dealt")).alias("ok"), F.sum("second").alias("k"),
                 F.every(F.col("second") == F.col("second_again")).alias("same"))
    return _flags(t, n_rows=F.col("n"), complete_and_disjoint=F.col("ok"),
                  within_bounds=F.abs(F.col("k") - F.col("n") * 0.2) <= 3 * F.sqrt("n"), same_elsewhere=F.col("same"))


@query("persisted", "SELECT count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem")
def persisted(spark, sf_dir):
    """One cached frame behind two aggregates."""
    with op.persisted(_t(spark, sf_dir, "lineitem").select("l_linenumber")) as li:
        n, total = li.count(), li.agg(F.sum("l_linenumber")).first()[0]
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_linenumber").alias("total")).filter(
        (F.col("n_rows") == n) & (F.col("total") == total)).select(
        "n_rows", "total")


@query("coalesce_to", "SELECT count(*) AS n_rows, true AS at_most_half FROM lineitem")
def coalesce_to(spark, sf_dir):
    """Half as many partitions as the scan has, without a shuffle."""
    li = _t(spark, sf_dir, "lineitem").select("l_linenumber")
    before = li.rdd.getNumPartitions()
    half = op.coalesce_to(li, max(before // 2, 1))
    return half.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), (F.count(F.lit(1)) <= max(before // 2, 1)).alias("at_most_half"))


# --------------------------- P14, P22, L1, L4, L5: nested documents of rows

@query("nested_fields", "SELECT p_partkey, p_brand AS brand, CAST(p_size AS INTEGER) AS size FROM part")
def nested_fields(spark, sf_dir):
    """Fields out of a struct in a struct."""
    p = _t(spark, sf_dir, "part").select("p_partkey", F.struct(F.struct("p_brand", F.col("p_size").cast("int").alias(
        "p_size")).alias("inner")).alias("outer"))
    return p.select("p_partkey", F.col("outer.inner.p_brand").alias("brand"), F.col("outer.inner.p_size").alias("size"))


@query("exploded_structs", """
SELECT o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def exploded_structs(spark, sf_dir):
    """An order's lines as arrays of structs (a chunk of a thousand lines
    each), one row per element again."""
    li = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    lists = op.grouped_lists(li, "o_orderkey", ["l_linenumber", "l_quantity"], "lines", chunk_rows=1000)
    o = _t(spark, sf_dir, "orders").select("o_orderkey").join(lists, "o_orderkey")
    return o.select("o_orderkey", F.explode("lines").alias("l")).select("o_orderkey", "l.l_linenumber", "l.l_quantity")


def _schema_catalog(spark, sf_dir):
    """One Avro document per part: a record with a nullable field, a nested
    record used twice (once by name) and an array; every fifth is a union."""
    doc = F.concat(
        F.lit('{"type":"record","name":"P","fields":[{"name":"k'), F.col("p_partkey").cast("string"),
        F.lit('","type":["null","long"],"doc":"'), F.col("p_brand"),
        F.lit('"},{"name":"box","type":{"type":"record","name":"Box","fields":[{"name":"size","type":"int"},'
              '{"name":"tags","type":{"type":"array","items":"string"}}]}},{"name":"spare","type":["null","Box"]}]}'))
    doc = F.when(F.col("p_partkey") % 5 == 0, F.lit('["null","string"]')).otherwise(doc)
    return _t(spark, sf_dir, "part").select(
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("subject"),
        F.col("p_partkey").alias("schemaId"), F.lit(1).alias("schemaVersion"), F.lit("AVRO").alias("schemaType"),
        doc.alias("schema"))


@query("schema_fields", """
WITH f AS (
  SELECT * FROM (VALUES (0, 'size', 'int', 'box.'), (0, 'tags', 'array', 'box.'),
                        (0, 'size', 'int', 'spare.'), (0, 'tags', 'array', 'spare.')) v(i, n, t, p))
SELECT 'part-' || p_partkey AS subject, 1 AS schemaVersion, p || n AS name, t AS type, '' AS description
FROM part, f WHERE p_partkey % 5 <> 0
UNION ALL SELECT 'part-' || p_partkey, 1, 'k' || p_partkey, 'long', p_brand FROM part WHERE p_partkey % 5 <> 0
UNION ALL SELECT 'part-' || p_partkey, 1, 'value', 'union', NULL FROM part WHERE p_partkey % 5 = 0
""")
def schema_fields_q(spark, sf_dir):
    """L1: fields of one schema document per part."""
    from quarry.lineage.catalog import schema_fields
    return schema_fields(_schema_catalog(spark, sf_dir))


@query("schema_facet", """
WITH docs AS (
  SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '["null","string"]' ELSE
    '{"type":"record","name":"P","fields":[{"name":"k' || p_partkey || '","type":["null","long"],"doc":"' || p_brand ||
    '"},{"name":"box","type":{"type":"record","name":"Box","fields":[{"name":"size","type":"int"},' ||
    '{"name":"tags","type":{"type":"array","items":"string"}}]}},{"name":"spare","type":["null","Box"]}]}' END AS doc
  FROM part)
SELECT 'part-' || p_partkey AS subject, 1 AS schemaVersion,
       '{"schemaRegistryUrl":"http://registry:8081","subject":"part-' || p_partkey || '","schemaId":' || p_partkey ||
       ',"schemaVersion":1,"schemaType":"AVRO","schema":"' || replace(doc, '"', chr(92) || '"') || '"}' AS facet
FROM docs
""")
def schema_facet_q(spark, sf_dir):
    """L4: one facet document per catalogue row, the schema document in it."""
    from quarry.lineage.catalog import schema_facet
    return schema_facet(_schema_catalog(spark, sf_dir), "http://registry:8081")


@query("lineage_fields", """
SELECT 'orders' AS namespace, CAST(o_orderkey AS VARCHAR) AS dataset, CAST(l_linenumber AS VARCHAR) AS name,
       l_returnflag AS type, l_linestatus AS description
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def lineage_fields_q(spark, sf_dir):
    """Run events with an order as input dataset and its lines as fields,
    an event for each thousand of them."""
    from quarry.lineage.catalog import lineage_fields
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("string").alias("name"),
                                              F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("description"))
    lists = op.grouped_lists(li, "l_orderkey", ["name", "type", "description"], "fields", chunk_rows=1000)
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")).join(lists, "l_orderkey")
    return lineage_fields(o.select(F.array(F.struct(
        F.lit("orders").alias("namespace"), F.col("l_orderkey").cast("string").alias("name"),
        F.struct(F.struct("fields").alias("schema")).alias("facets"))).alias("inputs")))
