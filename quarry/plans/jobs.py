"""End-to-end batch jobs in the shape of the reference programs: read
files, run a composed query, write or return the results. Each is a thin
composition of the library's functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import split_multi
from quarry.plans import catalog, composed
from quarry.schemas import MOVIE, RATING, TAG
from quarry.sources.files import parse_records, read_delimited, read_lines, rejected_records
from quarry.sources.sinks import write_result


def word_count_job(spark: SparkSession, input_path: str, output_path: str,
                   num_files: int | None = None, fmt: str = "csv") -> DataFrame:
    """Book word count: lines -> Java-split words -> counts, most frequent
    first -> result folder replaced. ``num_files=1`` gives one file, for a
    result that one task can sort and write."""
    counts = composed.word_count(read_lines(spark, input_path))
    write_result(counts, output_path, fmt=fmt, num_files=num_files)
    return counts


def genre_ranking_job(spark: SparkSession, movies_path: str, output_path: str,
                      sep: str = "@", num_files: int | None = None) -> DataFrame:
    """Genre ranking: third field of each movie line split on ``|``,
    counted and ranked, written to a result folder."""
    ranked = composed.count_multivalued(read_lines(spark, movies_path), "value", "|",
                                         field_index=2, field_sep=sep)
    write_result(ranked, output_path, fmt="csv", num_files=num_files)
    return ranked


def movielens_report(spark: SparkSession, movies_path: str, ratings_path: str,
                     sep: str = "@", min_votes: int = 100, top: int = 10,
                     mode: str = "failfast") -> dict[str, DataFrame]:
    """The three MovieLens questions over raw ``sep``-delimited lines:
    most common genres, busiest release years (top ``top``) and the best
    rated titles (inner join, more than ``min_votes`` votes). A line that
    does not parse fails the job; with ``mode="permissive"`` such lines are
    left out and counted in ``"rejected"``."""
    movie_lines, rating_lines = read_lines(spark, movies_path), read_lines(spark, ratings_path)
    movies = parse_records(movie_lines, MOVIE, sep=sep, mode=mode)
    ratings = parse_records(rating_lines, RATING, sep=sep, mode=mode)
    counts = [rejected_records(x, schema, sep).agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("rejected"))
              for name, x, schema in (("movies", movie_lines, MOVIE), ("ratings", rating_lines, RATING))]
    return {
        "rejected": counts[0].unionByName(counts[1]),
        "genres": composed.count_multivalued(movies, "genres", "|"),
        "years": composed.count_by_pattern(movie_lines, "value", top=top),
        "best": composed.best_rated(movies, ratings, "movieId", "title", "movieId", "rating",
                                     min_votes=min_votes, how="inner", top=top),
    }


def movielens_sql_report(spark: SparkSession, movies_path: str, ratings_path: str,
                         tags_path: str | None = None, sep: str = "@",
                         min_votes: int = 100) -> dict[str, DataFrame]:
    """The DataFrame/SQL walk-through: typed reads, projections and
    filters, views (the tags view holds the tags), SQL aggregates, the
    left-join best-rated query, a global view, a label projection and the
    mean rating joined to movie attributes."""
    movies = read_delimited(spark, movies_path, [f.name for f in MOVIE], sep, MOVIE)
    ratings = read_delimited(spark, ratings_path, [f.name for f in RATING], sep, RATING)
    views = {"movies": movies, "ratings": ratings}
    if tags_path:
        views["tags"] = read_delimited(spark, tags_path, [f.name for f in TAG], sep, TAG)
    catalog.register_views(spark, **views)
    return {
        "titles": movies.select("title"),
        "titles_2005": movies.filter(F.col("title").contains("2005")),
        "rating_plus_one": ratings.select("userId", "movieId", (F.col("rating") + 1).alias("rating_plus_one")),
        "low_ratings": ratings.filter(F.col("rating") < 2),
        "votes_per_movie": ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("count")),
        "mean_rating_sql": catalog.mean_by_key_sql(spark, "ratings", "movieId", "rating"),
        "counted_sql": catalog.count_by_key_sql(spark, "ratings", "movieId"),
        "best_sql": catalog.best_rated_sql(spark, "movies", "ratings", "movieId", "title", "movieId",
                                           "rating", min_votes),
        "global_movies": catalog.register_global_view(spark, movies, "gmovies"),
        "labels": movies.select(F.concat(F.lit("Movie: "), F.col("title")).alias("label")),
        "mean_with_movie": composed.mean_with_attributes(ratings, movies, "movieId", "rating"),
        "genre_values": movies.select(F.explode(split_multi("genres", "|")).alias("genre")),
    }
