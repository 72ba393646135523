"""Canonical record schemas (movie/rating/tag records, messages, catalog)."""

from pyspark.sql import types as T

MOVIE = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATING = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

TAG = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.IntegerType()),
])

# ALS input read from "::"-separated files: ids int, rating float, ts long.
ALS_RATING = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("timestamp", T.LongType()),
])

# The "all strings" record shapes used by typed-dataset conformance.
MOVIE_STRINGS = T.StructType([T.StructField(f.name, T.StringType()) for f in MOVIE])
RATING_STRINGS = T.StructType([T.StructField(f.name, T.StringType()) for f in RATING])

TEXT_MESSAGE = T.StructType([
    T.StructField("message_id", T.StringType(), False),
    T.StructField("message", T.StringType(), False),
])

BINARY_MESSAGE = T.StructType([
    T.StructField("message_id", T.StringType(), False),
    T.StructField("avro_data", T.BinaryType(), False),
])

PRODUCT = T.StructType([
    T.StructField("productName", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("material", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("promotionCode", T.StringType()),
])

PRODUCT_MESSAGE = T.StructType([
    T.StructField("creationDate", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("product", PRODUCT),
])

SCHEMA_CATALOG = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("schemaId", T.IntegerType()),
    T.StructField("schemaVersion", T.IntegerType()),
    T.StructField("schemaType", T.StringType()),
    T.StructField("schema", T.StringType()),
])

SCHEMA_FIELD = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("description", T.StringType()),
])
