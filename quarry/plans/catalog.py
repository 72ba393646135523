"""SQL surface (Q1-Q6): session / global views and the SQL statements.

Names may hold any character: columns and views go into the statements as
``IDENTIFIER`` parameters and values as parameters, never as text; only names
given to results are written out, quoted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A name of one part as SQL writes it."""
    return "`" + name.replace("`", "``") + "`"


def _relation(spark: SparkSession, view: str) -> str:
    """A session view of exactly this name, else a name of several parts."""
    return quoted(view) if spark.catalog.tableExists(quoted(view)) else view


def register_views(spark: SparkSession, **views: DataFrame) -> None:
    """Q1: register (or replace) session views by name."""
    for name, df in views.items():
        df.createOrReplaceTempView(quoted(name))


def register_global_view(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Q2: register a cross-session view and read it back as ``global_temp.name``."""
    df.createOrReplaceGlobalTempView(quoted(name))
    db = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    return spark.sql("SELECT * FROM IDENTIFIER(:view)", args={"view": f"{quoted(db)}.{quoted(name)}"})


def select_all(spark: SparkSession, view: str) -> DataFrame:
    """Q3."""
    return spark.sql("SELECT * FROM IDENTIFIER(:view)", args={"view": _relation(spark, view)})


def mean_by_key_sql(spark: SparkSession, view: str, key: str, value: str,
                    key_alias: str | None = None, name: str = "rating") -> DataFrame:
    """Q4: ``SELECT key, avg(value) ... GROUP BY key``."""
    return spark.sql(
        f"SELECT IDENTIFIER(:key) AS {quoted(key_alias or key)}, avg(IDENTIFIER(:value)) AS {quoted(name)} "
        "FROM IDENTIFIER(:view) GROUP BY IDENTIFIER(:key)",
        args={"view": _relation(spark, view), "key": quoted(key), "value": quoted(value)})


def count_by_key_sql(spark: SparkSession, view: str, key: str, key_alias: str | None = None,
                     name: str = "counted") -> DataFrame:
    """Q5: counts per key, most frequent first."""
    return spark.sql(
        f"SELECT IDENTIFIER(:key) AS {quoted(key_alias or key)}, count(*) AS {quoted(name)} FROM IDENTIFIER(:view) "
        "GROUP BY IDENTIFIER(:key) ORDER BY 2 DESC, 1", args={"view": _relation(spark, view), "key": quoted(key)})


def best_rated_sql(spark: SparkSession, movies: str, ratings: str, movie_key: str, title: str,
                   rating_key: str, rating: str, min_votes: int = 100) -> DataFrame:
    """Left join + group by title + HAVING on the alias + order.

    Written with the ratings reduced per item before the join (same result
    as joining first: an unrated item contributes one vote, no rating).
    """
    return spark.sql("""
        WITH r AS (
            SELECT IDENTIFIER(:rating_key) AS item, count(*) AS n, sum(IDENTIFIER(:rating)) AS s,
                   count(IDENTIFIER(:rating)) AS c
            FROM IDENTIFIER(:ratings) GROUP BY IDENTIFIER(:rating_key)),
        m AS (SELECT IDENTIFIER(:title) AS title, IDENTIFIER(:movie_key) AS item FROM IDENTIFIER(:movies))
        SELECT m.title,
               sum(coalesce(r.n, 1)) AS votes,
               try_divide(sum(r.s), sum(r.c)) AS rate
        FROM m LEFT JOIN r ON m.item = r.item
        GROUP BY m.title
        HAVING votes > :min_votes
        ORDER BY rate DESC NULLS LAST, title
    """, args={"movies": _relation(spark, movies), "ratings": _relation(spark, ratings), "movie_key": quoted(movie_key),
               "title": quoted(title), "rating_key": quoted(rating_key), "rating": quoted(rating), "min_votes": min_votes})
