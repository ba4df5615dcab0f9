"""Silver side tables: directors, keywords and the rating bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldmart.functions.literals import first_or_null, with_director, with_name_list
from goldmart.functions.numeric import once, rint_round, to_double, to_long_truncated
from goldmart.operators.clean import _order
from goldmart.operators.dedup import keep_first
from goldmart.operators.exact import limb_sums, merged_scales, scale_of, whole_of
from goldmart.sources.contracts import validate_columns


def _valid_ids(df: DataFrame, column: str = "id") -> DataFrame:
    return df.withColumn(column, once(to_long_truncated(df, column), "bigint")).where(F.col(column).isNotNull())


def _crew_parsed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    parsed = with_director(rows, "crew", "_d")
    return parsed.select("id", *order, F.col("_d.director").alias("director"), F.col("_d.malformed").alias("malformed"))


def parse_credits(credits: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """(id, order..., director, malformed): one row per credits row with a valid id."""
    validate_columns(credits, "credits")
    order = _order(credits, order_by)
    return _crew_parsed(_valid_ids(credits).select("id", *order, "crew"), order)


def first_directors(parsed: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """(id, director) of the first row per id; ids whose first row names no director are dropped even
    when a later row does."""
    first = keep_first(parsed, ["id"], _order(parsed, order_by))
    return first.where(F.col("director").isNotNull()).select("id", "director")


def build_directors(credits: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """``first_directors`` of raw credits. Only the first row of an id has a say, so the rows are found before they are parsed; who needs
    the malformed rows too takes ``parse_credits``."""
    validate_columns(credits, "credits")
    order = _order(credits, order_by)
    first = keep_first(_valid_ids(credits).select("id", *order, "crew"), ["id"], order)
    return _crew_parsed(first, order).where(F.col("director").isNotNull()).select("id", "director")


def _keywords_parsed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    parsed = with_name_list(rows, "keywords", "_k")
    return parsed.select("id", *order, F.col("_k.names").alias("keywords_list"), F.col("_k.malformed").alias("malformed"))


def parse_keywords(keywords: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """(id, order..., keywords_list, malformed): one row per keywords row with a valid id."""
    validate_columns(keywords, "keywords")
    order = _order(keywords, order_by)
    return _keywords_parsed(_valid_ids(keywords).select("id", *order, "keywords"), order)


def _keyword_columns(first: DataFrame) -> DataFrame:
    return first.select(
        "id", "keywords_list", first_or_null(F.col("keywords_list")).alias("primary_keyword"),
        F.size("keywords_list").cast("bigint").alias("keyword_count"),
    )


def first_keywords(parsed: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """(id, keywords_list, primary_keyword, keyword_count) of the first row per id; empty lists are kept."""
    return _keyword_columns(keep_first(parsed, ["id"], _order(parsed, order_by)))


def build_keywords(keywords: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """``first_keywords`` of raw keywords, parsed after the first rows are found (see ``build_directors``)."""
    validate_columns(keywords, "keywords")
    order = _order(keywords, order_by)
    first = keep_first(_valid_ids(keywords).select("id", *order, "keywords"), ["id"], order)
    return _keyword_columns(_keywords_parsed(first, order))


def parse_genres(movies: DataFrame) -> DataFrame:
    """Clean movies with ``genres_list`` and ``genres_malformed``, read from the genres text."""
    parsed = with_name_list(movies, "genres", "_g")
    return parsed.withColumns({"genres_list": F.col("_g.names"), "genres_malformed": F.col("_g.malformed")}).drop("_g")


def bridge_links(links: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """(movieId, tmdbId) with numeric keys, first mapping per movieId."""
    validate_columns(links, "links")
    order = _order(links, order_by)
    typed = links.select(
        once(to_long_truncated(links, "movieId"), "bigint").alias("movieId"),
        once(to_long_truncated(links, "tmdbId"), "bigint").alias("tmdbId"),
        *order,
    ).where(F.col("movieId").isNotNull() & F.col("tmdbId").isNotNull())
    return keep_first(typed, ["movieId"], order).select("movieId", "tmdbId")


def build_movie_ratings(
    links: DataFrame, ratings: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """(id, user_rating_avg, user_rating_count): ratings joined to links on movieId and averaged
    per tmdbId (rounded half-even to 2). Several movieIds may share one tmdbId.

    Ratings are pre-aggregated per movieId (map-side combine) before the join, so the join and
    the second aggregate see a row or two per movie instead of one per rating, and a movie holding a
    third of all ratings costs as few per map task. The sums are exact, so the mean does not depend on the order of ratings.
    """
    validate_columns(ratings, "ratings")
    bridge = bridge_links(links, order_by)
    rated = ratings.select(
        once(to_long_truncated(ratings, "movieId"), "bigint").alias("movieId"), once(to_double(ratings, "rating"), "double").alias("rating"))
    rated = rated.where(F.col("movieId").isNotNull() & F.col("rating").isNotNull()).withColumn("_scale", scale_of(F.col("rating")))
    whole = whole_of(F.col("rating"), F.col("_scale"))
    per_movie = rated.groupBy("movieId", "_scale").agg(*[agg.alias(part) for part, agg in limb_sums(whole, F.col("rating")).items()])
    joined = per_movie.join(bridge, "movieId", "inner").withColumnRenamed("tmdbId", "id")
    found = merged_scales(joined, ["id"], count="user_rating_count")
    return found.select("id", rint_round("_exact.mean", 2).alias("user_rating_avg"), F.col("user_rating_count").cast("bigint").alias("user_rating_count"))
