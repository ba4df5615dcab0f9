"""Gold assembly: one row per movie, 25 columns in contract order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldmart.constants import GOLD_COLUMNS
from goldmart.functions.dates import decade, iso_day_text, lenient_date
from goldmart.functions.literals import first_or_null
from goldmart.functions.numeric import rint_round
from goldmart.functions.text import present_text
from goldmart.operators.silver import parse_genres

_MOVIE_INPUTS = [
    "id", "title", "genres_list", "budget", "revenue", "vote_average", "vote_count", "popularity",
    "runtime", "original_language", "release_date", "belongs_to_collection", "overview", "status",
]


def roi_percent(revenue="revenue", budget="budget"):
    """(revenue - budget) / budget * 100, rounded half-even to 2; only for a positive budget."""
    r, b = F.col(revenue), F.col(budget)
    return F.when(b.isNotNull() & (b > F.lit(0.0)) & r.isNotNull(), rint_round((r - b) / b * F.lit(100.0), 2))


def movie_columns(movies: DataFrame) -> DataFrame:
    """Clean movies with the gold columns that need no other table: money, dates, decade and collection."""
    day = lenient_date("release_date")
    year = F.year(day)
    return movies.withColumns({
        "profit": F.col("revenue") - F.col("budget"), "roi": roi_percent(), "release_date": iso_day_text(day), "release_year": year.cast("int"),
        "decade": decade(year), "has_collection": present_text("belongs_to_collection"),
    })


def build_gold_dataset(movies: DataFrame, directors: DataFrame, keywords: DataFrame, ratings: DataFrame) -> DataFrame:
    """Clean movies (with a genres text or already with ``genres_list``), left-joined to the three one-row-per-id
    side tables.

    Genres are parsed first, so the joins carry the short list and not the text. Every side table is
    unique on ``id`` (no fan-out) and already hash-partitioned on it by its own dedup or aggregate, or stored in buckets by id
    (``write_bucketed``); then the joins need no exchange. AQE turns a join into a broadcast only when the measured side is below the broadcast threshold.
    """
    parsed = movies if "genres_list" in movies.columns else parse_genres(movies)
    joined = (
        movie_columns(parsed.select(*_MOVIE_INPUTS))
        .join(directors, "id", "left")
        .join(keywords, "id", "left")
        .join(ratings, "id", "left")
    )
    out = joined.select(
        F.col("id").cast("bigint").alias("id"),
        "title",
        first_or_null(F.col("genres_list")).alias("primary_genre"),
        "genres_list",
        "director",
        "primary_keyword",
        F.coalesce(F.col("keywords_list"), F.array().cast("array<string>")).alias("keywords_list"),
        F.coalesce(F.col("keyword_count"), F.lit(0)).cast("bigint").alias("keyword_count"),
        "budget",
        "revenue",
        "profit",
        "roi",
        "vote_average",
        "vote_count",
        "user_rating_avg",
        F.col("user_rating_count").cast("bigint").alias("user_rating_count"),
        "popularity",
        "runtime",
        "original_language",
        "release_date",
        "release_year",
        "decade",
        "has_collection",
        "overview",
        "status",
    )
    return out.select(*GOLD_COLUMNS)
