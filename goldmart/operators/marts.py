"""The analytic tables built on gold: grouped summaries, rankings and the correlation grid.

Every table is a lazy, ordered DataFrame. Measures are partial aggregates (map-side combine), so a
group holding a third of all rows ships a few partial rows per map task; sums and means are exact up to one final rounding
(``goldmart.operators.exact``), so they do not depend on the order of rows. The exact median needs more, see
``goldmart.operators.quantiles``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldmart import constants as K
from goldmart.functions.numeric import rint_round, scaled
from goldmart.operators.exact import exact_groups
from goldmart.operators.quantiles import LOCAL_ROWS, grouped_quantiles

_RATINGS = {"_vote": "vote_average", "_user": "user_rating_avg"}


def _rating_means() -> list[Column]:
    return [F.col("_vote.mean").alias("nota_metadata_media"), F.col("_user.mean").alias("nota_usuarios_media")]


def _present(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _rounded_select(df: DataFrame, columns: Sequence[str], rounded: Sequence[str], digits: int = 2):
    return df.select(*[rint_round(c, digits).alias(c) if c in rounded else F.col(c) for c in columns])


def revenue_by_genre(gold: DataFrame, key: str = "primary_genre") -> DataFrame:
    """Total revenue (billions), mean revenue (millions) and count per genre; sorted by the
    unrounded total, descending, then rounded."""
    agg = (
        exact_groups(gold.where(_present("revenue", key)), [key], {"_revenue": "revenue"}, {"qtd_filmes": "id"})
        .select(key, scaled("_revenue.total", 1e9).alias("receita_total_bi"), scaled("_revenue.mean", 1e6).alias("receita_media_mi"), "qtd_filmes")
        .orderBy(F.desc("receita_total_bi"), F.asc(key))
    )
    return _rounded_select(agg, [key, "receita_total_bi", "receita_media_mi", "qtd_filmes"],
                           ["receita_total_bi", "receita_media_mi"])


def top_directors(gold: DataFrame, min_count: int = K.MIN_DIRECTOR_FILMS, key: str = "director") -> DataFrame:
    """Directors with at least ``min_count`` movies with revenue; no row limit."""
    agg = (
        exact_groups(gold.where(_present("revenue", key)), [key], {"_revenue": "revenue", **_RATINGS}, {"qtd_filmes": "id"})
        .where(F.col("qtd_filmes") >= F.lit(min_count))
        .select(key, scaled("_revenue.total", 1e9).alias("receita_total_bi"), *_rating_means(), "qtd_filmes")
        .orderBy(F.desc("receita_total_bi"), F.asc(key))
    )
    cols = [key, "receita_total_bi", "nota_metadata_media", "nota_usuarios_media", "qtd_filmes"]
    return _rounded_select(agg, cols, cols[1:4])


def movies_by_decade(gold: DataFrame, key: str = "decade") -> DataFrame:
    """Count and mean vote, user rating and runtime per decade (revenue not required)."""
    agg = (
        exact_groups(gold.where(_present(key)), [key], {**_RATINGS, "_runtime": "runtime"}, {"qtd_filmes": "id"})
        .select(key, "qtd_filmes", *_rating_means(), F.col("_runtime.mean").alias("duracao_media"))
        .orderBy(F.asc(key))
    )
    cols = [key, "qtd_filmes", "nota_metadata_media", "nota_usuarios_media", "duracao_media"]
    return _rounded_select(agg, cols, cols[2:])


def explode_keywords(gold: DataFrame, measures: Sequence[str] = ("id", "revenue", "roi", "vote_average", "user_rating_avg")) -> DataFrame:
    """(measures..., keyword): one row per keyword occurrence; a keyword repeated within one
    movie counts twice, empty lists give no row."""
    return gold.select(*measures, F.explode("keywords_list").alias("keyword")).where(F.col("keyword").isNotNull())


def top_keywords(gold: DataFrame, min_count: int = K.MIN_KEYWORD_FILMS) -> DataFrame:
    """Count, mean revenue (millions) and mean user rating per keyword (revenue not required)."""
    measures = {"_revenue": "revenue", "_user": "user_rating_avg"}
    agg = (
        exact_groups(explode_keywords(gold), ["keyword"], measures, {"qtd_filmes": "id"})
        .where(F.col("qtd_filmes") >= F.lit(min_count))
        .select("keyword", "qtd_filmes", scaled("_revenue.mean", 1e6).alias("receita_media_mi"), F.col("_user.mean").alias("nota_usuarios_media"))
        .orderBy(F.desc("qtd_filmes"), F.desc_nulls_last("receita_media_mi"), F.asc("keyword"))
    )
    cols = ["keyword", "qtd_filmes", "receita_media_mi", "nota_usuarios_media"]
    return _rounded_select(agg, cols, cols[2:])


def group_summary(df: DataFrame, group_column: str, min_count: int, median: str = "exact", local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Success summary per group: count, total (billions), mean and median revenue (millions),
    mean ROI, vote and user rating. Rows need the key and revenue; groups below ``min_count``
    are dropped; values are rounded first, then sorted by rounded total and count, descending.

    ``median='exact'``: groups up to ``local_rows`` rows by the built-in exact percentile, larger ones by
    distributed selection (``grouped_quantiles``); ``median='approx'`` uses ``percentile_approx``.
    """
    base = df.where(_present(group_column, "revenue"))
    # roi has two decimals: its mean is taken over whole hundredths
    measures = {"_revenue": "revenue", "_roi": F.rint(F.col("roi") * F.lit(100.0)), **_RATINGS}
    agg = exact_groups(base, [group_column], measures, {"qtd_filmes": "id", "_n_roi": "roi"}).where(F.col("qtd_filmes") >= F.lit(min_count)).select(
        group_column, "qtd_filmes", F.col("_revenue.total").alias("_sum"), F.col("_revenue.mean").alias("_avg"),
        F.try_divide(F.col("_roi.total"), F.col("_n_roi") * F.lit(100.0)).alias("roi_medio"), *_rating_means(),
    )
    if median == "approx":
        agg = agg.join(base.groupBy(group_column).agg(F.percentile_approx("revenue", 0.5, 10000).cast("double").alias("_median")), group_column, "left")
    else:
        med = grouped_quantiles(base, [group_column], "revenue", [0.5], ["_median"], midpoint_mean=True, min_count=min_count, local_rows=local_rows)
        agg = agg.join(med, group_column, "left")
    cols = [
        F.col(group_column),
        F.col("qtd_filmes"),
        rint_round(scaled("_sum", 1e9)).alias("receita_total_bi"),
        rint_round(scaled("_avg", 1e6)).alias("receita_media_mi"),
        rint_round(scaled("_median", 1e6)).alias("receita_mediana_mi"),
        rint_round("roi_medio").alias("roi_medio"),
        rint_round("nota_metadata_media").alias("nota_metadata_media"),
        rint_round("nota_usuarios_media").alias("nota_usuarios_media"),
    ]
    return agg.select(*cols).orderBy(
        F.desc_nulls_last("receita_total_bi"), F.desc("qtd_filmes"), F.asc(group_column)
    )


def keyword_summary(gold: DataFrame, min_count: int = K.MIN_KEYWORD_FILMS) -> DataFrame:
    return group_summary(explode_keywords(gold), "keyword", min_count)


def correlation_grid(
    gold: DataFrame,
    features: Sequence[str] = K.CORRELATION_FEATURES,
    targets: Sequence[str] = K.CORRELATION_TARGETS,
    digits: int = 4,
) -> DataFrame:
    """Pearson correlation of every feature with every target over pairwise-complete rows, with
    the sample size; always len(features) * len(targets) rows.

    One aggregate pass for all pairs. ``corr`` raises on zero variance under ANSI, so the ratio is
    ``try_divide(covar_samp, stddev_samp * stddev_samp)``: null for n < 2 or zero variance.
    """
    aggs = []
    for t in targets:
        for f in features:
            both = F.col(f).isNotNull() & F.col(t).isNotNull()
            x, y = F.when(both, F.col(f)), F.when(both, F.col(t))
            tag = f"{t}__{f}"
            aggs += [
                F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(f"c__{tag}"),
                F.count_if(both).alias(f"n__{tag}"),
            ]
    wide = gold.agg(*aggs)
    rows = [
        F.struct(
            F.lit(t).alias("target"),
            F.lit(f).alias("feature"),
            (rint_round(F.col(f"c__{t}__{f}"), digits) + F.lit(0.0)).alias("correlation"),
            F.col(f"n__{t}__{f}").cast("bigint").alias("sample_size"),
            F.lit(i).alias("_i"),
        )
        for i, (t, f) in enumerate((t, f) for t in targets for f in features)
    ]
    long = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.orderBy(F.asc("target"), F.desc_nulls_last("correlation"), F.asc("_i")).drop("_i")


def top_films(
    gold: DataFrame,
    by: str = "revenue",
    limit: int = K.TOP_FILM_LIMIT,
    min_votes: float = K.TOP_FILM_MIN_VOTE_COUNT,
    min_budget: float | None = None,
) -> DataFrame:
    """Top ``limit`` movies by ``by`` (descending, id breaks ties) among rows with revenue and
    at least ``min_votes`` votes (missing votes count as 0); ``min_budget`` also requires roi,
    budget and budget >= min_budget. Planned as TakeOrderedAndProject: each task keeps its own
    top ``limit`` and only those reach the final merge."""
    cond = F.col("revenue").isNotNull() & (F.coalesce(F.col("vote_count"), F.lit(0.0)) >= F.lit(float(min_votes)))
    if min_budget is not None:
        cond = cond & _present("roi", "budget") & (F.col("budget") >= F.lit(float(min_budget)))
    top = gold.where(cond).orderBy(F.desc(by), F.asc("id")).limit(limit)
    return _rounded_select(top, K.TOP_FILM_COLUMNS, K.TOP_FILM_ROUNDED)


def top_films_by_revenue(gold: DataFrame, limit=K.TOP_FILM_LIMIT, min_votes=K.TOP_FILM_MIN_VOTE_COUNT) -> DataFrame:
    return top_films(gold, "revenue", limit, min_votes)


def top_films_by_roi(gold: DataFrame, limit=K.TOP_FILM_LIMIT, min_votes=K.TOP_FILM_MIN_VOTE_COUNT,
                     min_budget=K.TOP_FILM_MIN_BUDGET) -> DataFrame:
    return top_films(gold, "roi", limit, min_votes, min_budget)


def aggregation_builders(
    gold: DataFrame,
    min_director: int = K.MIN_DIRECTOR_FILMS,
    min_keyword: int = K.MIN_KEYWORD_FILMS,
    min_genre: int = K.MIN_GENRE_FILMS,
    min_decade: int = K.MIN_DECADE_FILMS,
    top_limit: int = K.TOP_FILM_LIMIT,
    top_min_votes: float = K.TOP_FILM_MIN_VOTE_COUNT,
    top_min_budget: float = K.TOP_FILM_MIN_BUDGET,
) -> dict[str, Callable[[], DataFrame]]:
    """One function per analytic table, keyed by output name: a caller plans only the tables it asks for."""
    return {
        "receita_por_genero": lambda: revenue_by_genre(gold),
        "top_diretores": lambda: top_directors(gold, min_director),
        "filmes_por_decada": lambda: movies_by_decade(gold),
        "top_palavras_chave": lambda: top_keywords(gold, min_keyword),
        "correlacoes_sucesso": lambda: correlation_grid(gold),
        "top_filmes_receita": lambda: top_films_by_revenue(gold, top_limit, top_min_votes),
        "top_filmes_roi": lambda: top_films_by_roi(gold, top_limit, top_min_votes, top_min_budget),
        "resumo_sucesso_por_genero": lambda: group_summary(gold, "primary_genre", min_genre),
        "resumo_sucesso_por_diretor": lambda: group_summary(gold, "director", min_director),
        "resumo_sucesso_por_decada": lambda: group_summary(gold, "decade", min_decade),
        "resumo_sucesso_por_palavra_chave": lambda: keyword_summary(gold, min_keyword),
    }


def build_aggregations(gold: DataFrame, **thresholds) -> dict[str, DataFrame]:
    """All eleven analytic tables, lazily, keyed by their output names (thresholds: see ``aggregation_builders``)."""
    return {name: build() for name, build in aggregation_builders(gold, **thresholds).items()}
