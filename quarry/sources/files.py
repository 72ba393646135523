"""Batch sources (S1-S8): text lines, delimited files, typed record parsing,
vectors, libsvm, JSON events, in-memory rows, number ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import regex_quote
from quarry.session import table_path

#: How a null is written in delimited files (an unlikely word; "" stays "").
NULL_FIELD = "\\N"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as ``DataFrame[value: string]``, one row per line."""
    return spark.read.text(path)


#: CSV settings under which any string, null included, is read back as it was
#: written: fields with special characters are quoted, quotes doubled, records
#: may span lines, blanks are kept, and "" is not null.
EXACT_CSV = {"quote": '"', "escape": '"', "escapeQuotes": "true", "multiLine": "true",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "emptyValue": "", "nullValue": NULL_FIELD, "lineSep": "\n"}


def read_delimited(spark: SparkSession, path: str, names: list[str], sep: str = "@",
                   schema: T.StructType | None = None, encoding: str = "UTF-8",
                   mode: str = "FAILFAST", exact: bool = False) -> DataFrame:
    """Header-less delimited file with renamed columns.

    A record that does not fit the schema fails the job; ``mode="PERMISSIVE"``
    makes its bad fields null and ``"DROPMALFORMED"`` leaves it out. With
    ``exact`` the file is read as ``write_result(fmt="csv")`` writes it.
    Pass ``schema`` in production: inference costs one extra full pass.
    """
    reader = (spark.read.option("header", "false").option("sep", sep)
              .option("encoding", encoding).option("mode", mode))
    if exact:
        reader = reader.options(**EXACT_CSV)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    out = reader.csv(path).toDF(*names)
    return unmark_nulls(out) if exact else out


def mark_nulls(df: DataFrame) -> DataFrame:
    """Strings that read like the null mark get one more backslash."""
    return _each_string(df, r"\A(\\+N)\z", r"\\$1")


def unmark_nulls(df: DataFrame) -> DataFrame:
    return _each_string(df, r"\A\\(\\+N)\z", "$1")


def _each_string(df: DataFrame, pattern: str, by: str) -> DataFrame:
    return df.select(*[F.regexp_replace(f"`{f.name}`", F.lit(pattern), F.lit(by)).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def _typed(schema: T.StructType) -> list:
    return [F.expr(f"try_cast(_p[{i}] AS {f.dataType.simpleString()})").alias(f.name)
            for i, f in enumerate(schema.fields)]


def _good(schema: T.StructType):
    """Right field count, and every field null or of its type."""
    ok = F.size("_p") == len(schema.fields)
    for i, f in enumerate(schema.fields):
        ok = ok & F.expr(f"try_cast(get(_p, {i}) AS {f.dataType.simpleString()})").isNotNull()
    return F.coalesce(ok, F.lit(False))


def parse_records(lines: DataFrame, schema: T.StructType, sep: str = "@",
                  mode: str = "failfast", col: str = "value") -> DataFrame:
    """S3: split delimited lines into typed records.

    ``mode="failfast"``: a wrong field count or a bad number fails the job
    (with or without ANSI mode). Every line that Spark reads is checked, which
    may be more than a later ``limit`` returns: the optimizer takes the limit
    after the check. ``mode="permissive"``: such lines are left
    out; :func:`rejected_records` gives them.
    """
    n = len(schema.fields)
    parts = F.split(F.col(col), regex_quote(sep), -1)
    if mode == "failfast":
        checked = F.when(F.size(parts) == n, parts).otherwise(
            F.raise_error(F.concat(F.lit(f"expected {n} fields: "), F.col(col))))
        fields = []
        for i, f in enumerate(schema.fields):
            raw = F.col("_p")[i]
            typed = F.expr(f"try_cast(_p[{i}] AS {f.dataType.simpleString()})")
            # fail on a bad value whatever spark.sql.ansi.enabled says
            bad = F.raise_error(F.concat(F.lit(f"bad {f.name}: "), raw))
            fields.append(F.when(raw.isNotNull() & typed.isNull(), bad).otherwise(typed).alias(f.name))
        return lines.select(checked.alias("_p")).select(*fields)
    if mode == "permissive":
        return lines.select(parts.alias("_p")).filter(_good(schema)).select(*_typed(schema))
    raise ValueError(f"unknown mode {mode!r}")


def rejected_records(lines: DataFrame, schema: T.StructType, sep: str = "@", col: str = "value") -> DataFrame:
    """The lines that ``parse_records(mode="permissive")`` leaves out, whole."""
    parts = F.split(F.col(col), regex_quote(sep), -1)
    return lines.select(F.col(col), parts.alias("_p")).filter(~_good(schema)).select(col)


def parse_vectors(lines: DataFrame, col: str = "value", sep: str = " ",
                  out: str = "features") -> DataFrame:
    """Separated numeric lines to ML dense vectors."""
    from pyspark.ml.functions import array_to_vector
    arr = F.split(F.trim(F.col(col)), regex_quote(sep)).cast("array<double>")
    return lines.select(array_to_vector(arr).alias(out))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """Libsvm file as ``(label double, features vector)``."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", str(num_features))
    return r.load(path)


def read_events(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON event files (one JSON document per line, or multiLine)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def literal_frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A small in-memory frame (tests, fixtures)."""
    return spark.createDataFrame(rows, schema)


def number_range(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """``id`` from 0 to n-1, generated on executors."""
    return spark.range(0, n, 1, num_partitions)
