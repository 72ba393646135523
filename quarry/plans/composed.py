"""Composed queries B1-B6: word count, multi-valued field ranking,
pattern counts, best rated item (two join semantics), mean with attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import first_match, jvm_split, jvm_split_trimmed, lines_of, split_multi


def text_lines(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
               out: str = "value", with_position: bool = False) -> DataFrame:
    """Multi-line texts to one row per line (every line of every text)."""
    keep = keep or []
    if with_position:
        return docs.select(*keep, F.posexplode(lines_of(text)).alias("line_no", out))
    return docs.select(*keep, F.explode(lines_of(text)).alias(out))


def words(lines: DataFrame, col: str = "value", drop_empty: bool = False, sep: str = " ",
          java_split: bool = True, out: str = "word") -> DataFrame:
    """One row per word of every line.

    ``java_split`` tokenises like ``String.split`` (trailing empties dropped);
    otherwise SQL ``split`` (all empties kept). ``drop_empty`` removes
    empty words (P18).
    """
    if java_split and sep == " ":
        # right-trim once in a projection below the generator (the CASE
        # expression would otherwise evaluate it twice per line)
        src = lines.select(F.col(col).alias("_v"), F.rtrim(F.col(col), F.lit(" ")).alias("_t"))
        w = src.select(F.explode(jvm_split_trimmed("_v", "_t")).alias(out))
    else:
        toks = jvm_split(col, sep) if java_split else F.split(F.col(col), sep)
        w = lines.select(F.explode(toks).alias(out))
    return w.filter(F.col(out) != "") if drop_empty else w


def word_count(lines: DataFrame, col: str = "value", drop_empty: bool = False,
               sep: str = " ", java_split: bool = True, sort: bool = True) -> DataFrame:
    """B1: ``(word, count)`` over all lines, most frequent first.

    The count is a partial + final hash aggregate (map-side combine), so a
    very frequent word ships one row per task through the shuffle.
    """
    counts = (words(lines, col, drop_empty, sep, java_split)
              .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
    return counts.orderBy(F.col("count").desc(), F.col("word")) if sort else counts


def count_multivalued(df: DataFrame, col: str, sep: str = "|", field_index: int | None = None,
                      field_sep: str = "@", out: str = "value", sort: bool = True) -> DataFrame:
    """B2: how often each value of a multi-valued field occurs.

    With ``field_index`` the field is first taken by position from a
    ``field_sep``-delimited line (P8), then split on ``sep`` (P21).
    """
    src = F.col(col)
    if field_index is not None:
        src = split_multi(src, field_sep)[field_index]
    counts = (df.select(F.explode(split_multi(src, sep)).alias(out))
              .groupBy(out).agg(F.count(F.lit(1)).alias("count")))
    return counts.orderBy(F.col("count").desc(), F.col(out)) if sort else counts


def count_by_pattern(lines: DataFrame, col: str = "value", pattern: str = r"\(([0-9]+)\)",
                     out: str = "year", top: int | None = 10, cast: str | None = "int") -> DataFrame:
    """Rows per first regex match (e.g. release year), top ``top``.

    Lines without a match are dropped (the reference crashes on them).
    ``cast`` types the key (``"int"`` by default, as release years are);
    a match too long for it fails under ANSI mode, so pass ``cast=None`` to
    keep the matched text when the input may hold such digit runs.
    """
    key = first_match(col, pattern)
    m = lines.select(key.alias(out)).filter(F.col(out) != "")
    if cast:
        m = m.select(F.col(out).cast(cast).alias(out))
    counts = m.groupBy(out).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.col("count").desc(), F.col(out))
    return ordered.limit(top) if top else ordered


def best_rated(items: DataFrame, ratings: DataFrame, item_key: str, title: str,
               rating_item_key: str, rating: str, min_votes: int = 100, how: str = "inner",
               top: int | None = 10) -> DataFrame:
    """Best mean rating per title among titles with more than
    ``min_votes`` votes. Items sharing a title are merged.

    ``how="inner"``: only rated items count; votes = matched ratings.
    ``how="left"``: every item counts; an unrated item adds one vote and no
    rating (SQL ``count(*)`` over a left join), mean over ratings present.

    Ratings are first reduced to one row per item (partial aggregate), so
    the join and the title aggregation see one row per item, and a hot item
    never funnels its ratings through one join task.
    """
    per_item = (ratings.groupBy(F.col(rating_item_key).alias(item_key))
                .agg(F.count(F.lit(1)).alias("_rows"), F.sum(rating).alias("_sum"),
                     F.count(rating).alias("_cnt")))
    it = items.select(item_key, title)
    if how == "inner":
        joined = it.join(per_item, item_key, "inner")
        votes = F.sum("_rows")
    elif how == "left":
        joined = it.join(per_item, item_key, "left")
        votes = F.sum(F.coalesce(F.col("_rows"), F.lit(1)))
    else:
        raise ValueError("how must be 'inner' or 'left'")
    res = (joined.groupBy(F.col(title).alias("title"))
           .agg(votes.alias("votes"), F.sum("_sum").alias("_s"), F.sum("_cnt").alias("_c"))
           .filter(F.col("votes") > min_votes)
           .select("title", "votes", F.try_divide(F.col("_s"), F.col("_c")).alias("rate")))
    ordered = res.orderBy(F.col("rate").desc_nulls_last(), F.col("title"))
    return ordered.limit(top) if top else ordered


def mean_with_attributes(ratings: DataFrame, items: DataFrame, key: str, rating: str,
                         rating_key: str | None = None, name: str = "avg_rating") -> DataFrame:
    """Mean rating per item joined to the item's attributes, one key
    column (``join(on=key)``), the mean aliased."""
    means = (ratings.groupBy(F.col(rating_key or key).alias(key))
             .agg(F.avg(rating).alias(name)))
    return means.join(items, key, "inner")
