"""Chart-ready feeds: the data behind the four charts, as DataFrames (no drawing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldmart import constants as K
from goldmart.functions.numeric import scaled


def genre_bars(receita_por_genero: DataFrame) -> DataFrame:
    """Revenue by genre in bar order: the table's order reversed (smallest total first)."""
    return receita_por_genero.select("primary_genre", "receita_total_bi").orderBy(
        F.asc("receita_total_bi"), F.desc("primary_genre")
    )


def decade_dual(filmes_por_decada: DataFrame) -> DataFrame:
    """Decade label (text), movie count and mean user rating, by decade."""
    return filmes_por_decada.select(
        F.col("decade").cast("string").alias("decada"), "qtd_filmes", "nota_usuarios_media"
    ).orderBy(F.col("decade"))


def _cost_revenue_rows(gold: DataFrame, min_budget: float, min_revenue: float) -> DataFrame:
    return gold.where(
        F.col("budget").isNotNull()
        & F.col("revenue").isNotNull()
        & (F.col("budget") > F.lit(float(min_budget)))
        & (F.col("revenue") > F.lit(float(min_revenue)))
    )


def cost_revenue(gold: DataFrame, min_budget: float = K.TOP_FILM_MIN_BUDGET, min_revenue: float = K.FEED_MIN_REVENUE) -> DataFrame:
    """Scatter points: budget and revenue in millions, coloured by vote average (strict > on
    both thresholds)."""
    return _cost_revenue_rows(gold, min_budget, min_revenue).select(
        scaled("budget", 1e6).alias("orcamento_mi"),
        scaled("revenue", 1e6).alias("receita_mi"),
        "vote_average",
    )


def cost_revenue_max(gold: DataFrame, min_budget: float = K.TOP_FILM_MIN_BUDGET, min_revenue: float = K.FEED_MIN_REVENUE) -> DataFrame:
    """One row: the end of the cost = revenue diagonal, max(budget, revenue) in millions."""
    return _cost_revenue_rows(gold, min_budget, min_revenue).agg(
        scaled(F.greatest(F.max("budget"), F.max("revenue")), 1e6).alias("max_mi")
    )


def cost_revenue_binned(
    gold: DataFrame,
    bins: int = 50,
    min_budget: float = K.TOP_FILM_MIN_BUDGET,
    min_revenue: float = K.FEED_MIN_REVENUE,
) -> DataFrame:
    """The scatter at any scale: an equal-width grid over [0, max] on both axes, with the point
    count and mean vote per cell."""
    rows = _cost_revenue_rows(gold, min_budget, min_revenue)
    # the grid end is a scalar subquery: computed once, then used as a constant (no join)
    top = rows.agg(F.greatest(F.max("budget"), F.max("revenue"))).scalar()
    grid = rows.withColumn("_max", top)
    cell = lambda c: F.least(F.floor(F.col(c) / F.col("_max") * F.lit(bins)), F.lit(bins - 1)).cast("int")
    return (
        grid.select(cell("budget").alias("faixa_orcamento"), cell("revenue").alias("faixa_receita"), "vote_average", "_max")
        .groupBy("faixa_orcamento", "faixa_receita")
        .agg(
            F.count(F.lit(1)).alias("qtd_filmes"),
            F.avg("vote_average").alias("nota_media"),
            scaled(F.max("_max"), 1e6 * bins).alias("largura_mi"),
        )
        .orderBy("faixa_orcamento", "faixa_receita")
    )


def corr_matrix(correlacoes: DataFrame, targets: Sequence[str] = K.CORRELATION_TARGETS) -> DataFrame:
    """feature x target grid of correlations; the pivot values are given, so no extra job."""
    return (
        correlacoes.groupBy("feature")
        .pivot("target", list(targets))
        .agg(F.max("correlation"))
        .orderBy("feature")
    )
