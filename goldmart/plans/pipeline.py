"""End-to-end batch run: raw CSVs -> bronze -> silver -> gold -> analytic tables -> files."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldmart import constants as K
from goldmart.operators import feeds, marts, profile
from goldmart.operators.clean import clean_movies
from goldmart.operators.gold import build_gold_dataset
from goldmart.operators.silver import (
    build_directors, build_keywords, build_movie_ratings, first_directors, first_keywords, parse_credits, parse_genres, parse_keywords,
)
from goldmart.sinks.versions import publish
from goldmart.sinks.writers import BOUNDED_TABLES, manifest, write_bucketed, write_csv, write_keyed, write_parquet
from goldmart.sources.bronze import load_raw_datasets


def write_silver(
    raw: Mapping[str, DataFrame], out_dir: str, order_by: Mapping[str, Sequence[str]] | None = None, null_title: str = "drop"
) -> dict[str, DataFrame]:
    """Write the silver stages below ``out_dir`` and read them back. ``credits`` and ``keyword_rows`` are the parsed
    rows before the dedup, with their ``malformed`` flags: every counter is taken from a written table, so a
    stage that runs again after a lost executor cannot count twice. The four tables that gold joins are bucketed by id alike, so the
    joins need no shuffle."""
    by = dict(order_by or {})
    out = out_dir.rstrip("/")
    spark = raw["movies"].sparkSession

    def written(name: str, df: DataFrame) -> DataFrame:
        return spark.read.parquet(write_parquet(df, f"{out}/{name}"))

    credits = written("credits", parse_credits(raw["credits"], by.get("credits")))
    keyword_rows = written("keyword_rows", parse_keywords(raw["keywords"], by.get("keywords")))
    tables = silver_tables(raw, by, null_title, credits, keyword_rows)
    return {"credits": credits, "keyword_rows": keyword_rows, **{name: write_bucketed(df, f"{out}/{name}", "id") for name, df in tables.items()}}


def silver_tables(
    raw: Mapping[str, DataFrame], order_by: Mapping[str, Sequence[str]], null_title: str = "drop",
    credits: DataFrame | None = None, keyword_rows: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The four tables that gold joins, one row per id each, not written; ``credits`` and ``keyword_rows`` are the parsed rows, if they are
    stored already."""
    by = dict(order_by)
    in_credits, in_keywords = by.get("credits"), by.get("keywords")
    return {
        "clean": parse_genres(clean_movies(raw["movies"], order_by=by.get("movies"), null_title=null_title)),
        "directors": build_directors(raw["credits"], in_credits) if credits is None else first_directors(credits, in_credits),
        "keywords": build_keywords(raw["keywords"], in_keywords) if keyword_rows is None else first_keywords(keyword_rows, in_keywords),
        "ratings": build_movie_ratings(raw["links"], raw["ratings"], order_by=by.get("links")),
    }


def malformed_counts(silver: Mapping[str, DataFrame]) -> dict[str, int]:
    """Malformed rows per parsed field, with a warning for each field that has some."""
    flags = {
        "credits.crew": (silver["credits"], "malformed"), "keywords.keywords": (silver["keyword_rows"], "malformed"),
        "movies.genres": (silver["clean"], "genres_malformed"),
    }
    counts = {field: df.agg(F.count_if(flag)).first()[0] for field, (df, flag) in flags.items()}
    for field, n in counts.items():
        if n:
            warnings.warn(f"{field}: {n} rows with malformed content were ignored.", RuntimeWarning)
    return counts


def save_outputs(out_dir: str, gold: DataFrame, tables: Mapping[str, DataFrame], gold_written: str | None = None) -> dict[str, str]:
    """Gold as Parquet and CSV, every analytic table as CSV, each published as a new version (``goldmart.sinks.versions``): whoever reads
    an output meets the old one or the whole new one. Returns the new versions' folders.
    ``gold_written``: the Parquet already holds this gold, do not write it again."""
    out = out_dir.rstrip("/")
    paths = {"filmes_processados_parquet": gold_written or publish(gold, f"{out}/filmes_processados_parquet", write_keyed)}
    paths["filmes_processados_csv"] = publish(gold, f"{out}/filmes_processados.csv", write_csv)
    for name, df in tables.items():
        paths[name] = publish(df, f"{out}/{name}.csv", lambda table, folder, one=name in BOUNDED_TABLES: write_csv(table, folder, single_file=one))
    return paths


def chart_feeds(
    gold: DataFrame,
    tables: Mapping[str, DataFrame],
    min_budget: float = K.TOP_FILM_MIN_BUDGET,
    min_revenue: float = K.FEED_MIN_REVENUE,
) -> dict[str, DataFrame]:
    """The data behind the four charts (bars by genre, decades, budget vs revenue with its
    diagonal and a binned form for any scale, correlation heat map)."""
    return {
        "receita_por_genero": feeds.genre_bars(tables["receita_por_genero"]),
        "filmes_por_decada": feeds.decade_dual(tables["filmes_por_decada"]),
        "orcamento_vs_receita": feeds.cost_revenue(gold, min_budget, min_revenue),
        "orcamento_vs_receita_grade": feeds.cost_revenue_binned(gold, 50, min_budget, min_revenue),
        "orcamento_vs_receita_diagonal": feeds.cost_revenue_max(gold, min_budget, min_revenue),
        "correlacoes_sucesso": feeds.corr_matrix(tables["correlacoes_sucesso"]),
    }


def save_chart_feeds(out_dir: str, frames: Mapping[str, DataFrame]) -> dict[str, str]:
    feed_dir = f"{out_dir.rstrip('/')}/visualizacoes"
    bounded = ("orcamento_vs_receita_diagonal", "correlacoes_sucesso")
    return {
        name: publish(df, f"{feed_dir}/{name}.csv", lambda feed, folder, one=name in bounded: write_csv(feed, folder, single_file=one))
        for name, df in frames.items()
    }


def run_frames(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out_dir: str,
    order_by: Mapping[str, Sequence[str]] | None = None,
    thresholds: Mapping[str, float] | None = None,
    write_feeds: bool = True,
    null_title: str = "drop",
) -> dict:
    """Build and write everything from raw (bronze) frames keyed movies/credits/keywords/links/
    ratings. Gold is written once and read back: its lineage is cut there, and the eleven tables
    read the Parquet (column-pruned) instead of recomputing joins and parsing."""
    th = dict(thresholds or {})
    out = out_dir.rstrip("/")
    silver = write_silver(raw, f"{out}/silver", order_by, null_title)
    gold_plan = build_gold_dataset(silver["clean"], silver["directors"], silver["keywords"], silver["ratings"])
    gold_path = publish(gold_plan, f"{out}/filmes_processados_parquet", write_keyed)
    malformed = malformed_counts(silver)
    gold = spark.read.parquet(gold_path)

    tables = marts.build_aggregations(
        gold,
        min_director=th.get("min_director", K.MIN_DIRECTOR_FILMS),
        min_keyword=th.get("min_keyword", K.MIN_KEYWORD_FILMS),
        min_genre=th.get("min_genre", K.MIN_GENRE_FILMS),
        min_decade=th.get("min_decade", K.MIN_DECADE_FILMS),
        top_limit=th.get("top_limit", K.TOP_FILM_LIMIT),
        top_min_votes=th.get("top_min_votes", K.TOP_FILM_MIN_VOTE_COUNT),
        top_min_budget=th.get("top_min_budget", K.TOP_FILM_MIN_BUDGET),
    )
    paths = save_outputs(out, gold, tables, gold_written=gold_path)
    feed_paths = {}
    if write_feeds:
        feed_paths = save_chart_feeds(
            out, chart_feeds(gold, tables, th.get("feed_min_budget", K.TOP_FILM_MIN_BUDGET),
                             th.get("feed_min_revenue", K.FEED_MIN_REVENUE))
        )

    # The keys of the summaries below.
    # raw is counted once: these few rows are collected and serve all that follows
    raw_rows = {r["dataset"]: r["linhas"] for r in profile.shapes(raw).collect()}
    counted = profile.stage_counters(raw, silver["clean"], silver["directors"], silver["keywords"], silver["ratings"], gold, raw_rows=raw_rows)
    counter_rows = counted.collect()
    stage_summary: dict = {}
    for r in counter_rows:
        stage_summary.setdefault(r["etapa"], {})[r["indicador"]] = r["valor"]
    stage_summary["fontes"]["arquivos"] = list(K.REQUIRED_RAW_FILES.values())
    stage_summary["carregamento"] = {
        "csv_principal": paths["filmes_processados_csv"],
        "parquet_principal": paths["filmes_processados_parquet"],
        "tabelas_geradas": len(tables),
    }
    stage_summary["destino"] = {
        "dataset_gold": paths["filmes_processados_csv"],
        "parquet_gold": paths["filmes_processados_parquet"],
        "quantidade_graficos": len(feed_paths),
    }
    return {
        "gold": gold,
        "tables": tables,
        "paths": paths,
        "feed_paths": feed_paths,
        "malformed": malformed,
        "source_summary": [
            {"dataset": name, "arquivo": K.REQUIRED_RAW_FILES.get(name), "linhas": raw_rows[name],
             "colunas": len(profile.visible(df.columns))}
            for name, df in raw.items()
        ],
        "stage_summary": stage_summary,
        "stage_counters": spark.createDataFrame(counter_rows, counted.schema),
        "silver": silver,
        "output_summary": {"processed_dir": out, "arquivos_saida": paths, "graficos": feed_paths},
        # inspection views, lazy: nothing runs unless a caller asks for them
        "views": {
            "valores_ausentes": profile.null_profile(raw["movies"], silver["clean"]),
            "estatisticas_numericas": profile.describe_numeric(gold),
            "linhas_por_tabela": profile.table_row_counts(tables),
            "registro_bruto_vs_final": profile.raw_vs_gold(raw["movies"], gold),
            "tipos_das_colunas": profile.gold_dtypes(gold),
            "destaques": profile.highlights(tables["receita_por_genero"], tables["top_diretores"], tables["filmes_por_decada"]),
        },
    }


def run(spark: SparkSession, raw_dir: str, out_dir: str, on_long_row: str = "fail", **kwargs) -> dict:
    """The whole pipeline from a folder holding the five raw CSVs."""
    raw = load_raw_datasets(spark, raw_dir, f"{out_dir.rstrip('/')}/bronze", on_long_row=on_long_row)
    result = run_frames(spark, raw, out_dir, **kwargs)
    result["manifest"] = manifest(spark, [p for p in result["paths"].values()])
    return result
