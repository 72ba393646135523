from pyspark.sql import functions as F

from quarry.plans import catalog, composed

MOVIES = [(1, "Alpha"), (2, "Beta"), (3, "Alpha"), (4, "Gamma")]
# Alpha: items 1 and 3 (merged by title); Gamma unrated.
RATINGS = [(u, 1, 5.0) for u in range(3)] + [(u, 3, 3.0) for u in range(2)] + [(u, 2, 4.0) for u in range(4)]


def _frames(spark):
    m = spark.createDataFrame(MOVIES, "movieId int, title string")
    r = spark.createDataFrame(RATINGS, "userId int, movieId int, rating double")
    return m, r


def test_best_rated_inner_merges_titles(spark):
    m, r = _frames(spark)
    got = [tuple(x) for x in composed.best_rated(m, r, "movieId", "title", "movieId", "rating",
                                                  min_votes=3, how="inner").collect()]
    assert got == [("Alpha", 5, 4.2), ("Beta", 4, 4.0)]


def test_best_rated_threshold_is_exclusive(spark):
    m, r = _frames(spark)
    got = {x.title: (x.votes, x.rate) for x in composed.best_rated(
        m, r, "movieId", "title", "movieId", "rating", min_votes=3, how="inner").collect()}
    assert got == {"Alpha": (5, 4.2), "Beta": (4, 4.0)}
    got4 = composed.best_rated(m, r, "movieId", "title", "movieId", "rating", min_votes=4).collect()
    assert [x.title for x in got4] == ["Alpha"]


def test_best_rated_left_counts_unrated_item_as_one_vote(spark):
    m, r = _frames(spark)
    got = {x.title: (x.votes, x.rate) for x in composed.best_rated(
        m, r, "movieId", "title", "movieId", "rating", min_votes=0, how="left", top=None).collect()}
    assert got == {"Alpha": (5, 4.2), "Beta": (4, 4.0), "Gamma": (1, None)}
    catalog.register_views(spark, movies=m, ratings=r)
    sql = {x.title: (x.votes, x.rate) for x in catalog.best_rated_sql(
        spark, "movies", "ratings", "movieId", "title", "movieId", "rating", min_votes=0).collect()}
    assert sql == got


def test_word_count_and_multivalued(spark):
    lines = spark.createDataFrame([("a b a",), ("b  ",), ("",)], "value string")
    wc = {r.word: r["count"] for r in composed.word_count(lines).collect()}
    assert wc == {"a": 2, "b": 2, "": 1}
    ne = {r.word: r["count"] for r in composed.word_count(lines, drop_empty=True, java_split=False).collect()}
    assert ne == {"a": 2, "b": 2}
    mv = spark.createDataFrame([("1@T (1995)@Animation|Comedy",), ("2@U (1996)@Comedy",)], "value string")
    g = [tuple(r) for r in composed.count_multivalued(mv, "value", "|", field_index=2).collect()]
    assert g == [("Comedy", 2), ("Animation", 1)]


def test_count_by_pattern_first_match_and_drop(spark):
    lines = spark.createDataFrame([("1@(500) Days (2009)@x",), ("2@A (2009)@y",), ("3@none@z",)],
                                  "value string")
    got = [tuple(r) for r in composed.count_by_pattern(lines).collect()]
    assert got == [(500, 1), (2009, 1)]
    text = [tuple(r) for r in composed.count_by_pattern(lines, cast=None).collect()]
    assert text == [("2009", 1), ("500", 1)]  # string keys, ordered as text on ties


def test_mean_with_attributes_single_key(spark):
    m, r = _frames(spark)
    out = composed.mean_with_attributes(r, m, "movieId", "rating")
    assert out.columns == ["movieId", "avg_rating", "title"]
    assert {x.movieId: x.avg_rating for x in out.collect()} == {1: 5.0, 2: 4.0, 3: 3.0}


def test_views_and_global_view(spark):
    m, r = _frames(spark)
    catalog.register_views(spark, movies=m, ratings=r)
    assert catalog.select_all(spark, "movies").count() == 4
    g = catalog.register_global_view(spark, m, "gmovies_test")
    g2 = catalog.register_global_view(spark, m, "gmovies_test")  # replace, no error
    assert g.count() == g2.count() == 4
    top = catalog.count_by_key_sql(spark, "ratings", "movieId").first()
    assert (top.movieId, top.counted) == (2, 4)
    mean = {x.movieId: x.rating for x in catalog.mean_by_key_sql(spark, "ratings", "movieId", "rating").collect()}
    assert mean == {1: 5.0, 2: 4.0, 3: 3.0}


def test_conform_upcasts_to_strings(spark):
    from quarry.schemas import MOVIE_STRINGS
    df = spark.createDataFrame([("G", "T", 1)], "genres string, title string, movieId int")
    out = df.to(MOVIE_STRINGS)
    assert out.columns == ["movieId", "title", "genres"] and out.first().movieId == "1"
    assert F is not None


def test_names_resolve_case_insensitively_and_aliases_fix_output(spark):
    _, r = _frames(spark)
    out = r.select(F.col("userid"), (F.col("RATING") + 1).alias("rating_plus_one"))
    assert out.columns == ["userid", "rating_plus_one"]  # spelling of the query, hence: alias
    assert out.count() == len(RATINGS)
