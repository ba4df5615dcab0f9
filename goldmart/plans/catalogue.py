"""Query catalogue over TESTDATA: one callable per operator group, each (spark, sf_dir) -> DataFrame.

Every query runs the library operators on frames Spark derives from the given tables (see
``goldmart.plans.frames``); ``goldmart.plans.oracle`` holds the matching DuckDB SQL. Doubles are
rounded in the library where the contract says so; the rest is rounded here, alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.constants import REQUIRED_RAW_FILES
from goldmart.functions.literals import with_name_list
from goldmart.functions.numeric import rint_round, to_double, to_long_truncated
from goldmart.functions.text import blank_to_null, normalize_na_tokens
from goldmart.operators import feeds, marts, profile
from goldmart.operators.clean import adult_flag, clean_counters, clean_movies
from goldmart.operators.exact import exact_groups
from goldmart.operators.gold import build_gold_dataset, movie_columns
from goldmart.operators.silver import build_directors, build_keywords, build_movie_ratings
from goldmart.plans import frames as fr
from goldmart.plans.frames import LINE_ORDER, THRESHOLDS as TH
from goldmart.plans.pipeline import run_frames, silver_tables
from goldmart.session import materialize, scratch_path
from goldmart.sinks.writers import manifest, write_bucketed, write_csv, write_keyed, write_parquet, write_tables
from goldmart.sources.bronze import read_raw_csv


# ----------------------------------------------------------------------------- shared builders
def raw_frames(spark: SparkSession, d: str, varied_ratings: bool = False) -> dict[str, DataFrame]:
    return {
        "movies": fr.order_movies(spark, d),
        "credits": fr.order_credits(spark, d),
        "keywords": fr.order_keywords(spark, d),
        "links": fr.order_links(spark, d),
        "ratings": fr.order_ratings(spark, d, varied=varied_ratings),
    }


def order_gold(spark: SparkSession, d: str) -> DataFrame:
    raw = raw_frames(spark, d)
    return build_gold_dataset(
        clean_movies(raw["movies"]), build_directors(raw["credits"], order_by=LINE_ORDER),
        build_keywords(raw["keywords"], order_by=LINE_ORDER), build_movie_ratings(raw["links"], raw["ratings"]),
    )


def stored_gold(spark: SparkSession, d: str) -> DataFrame:
    """The order mart's gold, written below ``spark.checkpoint.dir`` and read back: for callers that read
    it more than once. Nothing is kept between calls."""
    return materialize(order_gold(spark, d), "order-gold")


def staged_gold(spark: SparkSession, d: str) -> DataFrame:
    """The order mart's gold on stored side tables, not written itself. They are stored one after the other, in buckets by id, and the shuffles of
    one are gone before those of the next are written: in one plan with all four tables the disk holds the shuffles of all of them at once."""
    s = silver_tables(raw_frames(spark, d), {"credits": LINE_ORDER, "keywords": LINE_ORDER})
    stored = {name: write_bucketed(s[name], scratch_path(spark, f"silver-{name}"), "id") for name in ("keywords", "directors", "ratings")}
    return build_gold_dataset(s["clean"], **stored)


def order_builders(gold: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    names = ("min_director", "min_keyword", "min_genre", "min_decade", "top_limit", "top_min_votes", "top_min_budget")
    return marts.aggregation_builders(gold, **{n: TH[n] for n in names})


def order_tables(spark: SparkSession, d: str, gold: DataFrame | None = None) -> dict[str, DataFrame]:
    g = stored_gold(spark, d) if gold is None else gold
    return {name: build() for name, build in order_builders(g).items()}


def flat(df: DataFrame, sep: str = "|") -> DataFrame:
    """Lists joined to text, so both engines compare plain values."""
    return df.select(*[
        F.array_join(F.col(f.name), sep).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _dirty(spark: SparkSession, d: str) -> DataFrame:
    return normalize_na_tokens(fr.dirty_movies(spark, d))


# ----------------------------------------------------------------------------- queries
def q_na_tokens_to_null(spark, d):
    return normalize_na_tokens(fr.na_texts(spark, d))


def q_source_summary(spark, d):
    return profile.shapes(raw_frames(spark, d), REQUIRED_RAW_FILES)


def q_clean_ids_keep_first(spark, d):
    c = clean_movies(_dirty(spark, d), order_by=LINE_ORDER)
    return c.select("id", "title", "adult", "budget", "revenue", "runtime", "vote_count", "status")


def q_clean_counters(spark, d):
    return clean_counters(_dirty(spark, d))


def q_coerce_numeric(spark, d):
    t = fr.number_texts(spark, d)
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "texto",
                    to_double(t, "texto").alias("numero"), to_long_truncated(t, "texto").alias("inteiro"))


def q_clean_entities(spark, d):
    t = _dirty(spark, d)
    budget = F.nullif(to_double(t, "budget"), F.lit(0.0))
    runtime = to_double(t, "runtime")
    adult = adult_flag("adult")
    title = blank_to_null("title")
    kept = ~adult & title.isNotNull() & runtime.isNotNull() & (runtime > F.lit(0.0))
    return t.select(F.col("_okey").alias("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", adult.alias("adulto"),
                    title.alias("titulo"), budget.alias("orcamento"), kept.alias("mantido"))


def q_parse_names(spark, d):
    t = with_name_list(fr.literal_texts(spark, d), "literal", "_p")
    return t.select("p_partkey", "variante", F.array_join("_p.names", "|").alias("nomes"),
                    F.size("_p.names").alias("qtd_nomes"), F.col("_p.malformed").alias("malformada"))


def q_malformed_count(spark, d):
    t = with_name_list(fr.literal_texts(spark, d), "literal", "_p")
    return t.groupBy("variante").agg(F.count(F.lit(1)).alias("linhas"),
                                     F.count_if(F.col("_p.malformed")).alias("malformadas"))


def q_first_matching_member(spark, d):
    return build_directors(fr.order_credits(spark, d), order_by=LINE_ORDER)


def q_keyword_table(spark, d):
    return flat(build_keywords(fr.order_keywords(spark, d), order_by=LINE_ORDER))


def q_rating_bridge(spark, d):
    return build_movie_ratings(fr.order_links(spark, d), fr.order_ratings(spark, d, varied=True))


def q_exact_sums(spark, d):
    """Sums and means of ordinary doubles, to the last bit: charged amounts per supplier."""
    li = fr.table(spark, d, "lineitem")
    charged = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) * (F.lit(1.0) + F.col("l_tax"))
    found = exact_groups(li, ["l_suppkey"], {"_charged": charged}, {"linhas": "l_orderkey"})
    return found.select("l_suppkey", "linhas", F.col("_charged.total").alias("total"), F.col("_charged.mean").alias("media"))


def q_gold_dataset(spark, d):
    return flat(order_gold(spark, d))


def _on_gold(build: Callable[[SparkSession, str, DataFrame], DataFrame], source=order_gold) -> Callable[..., DataFrame]:
    """A query that reads gold once: gold is part of its plan, or is handed in as ``gold``."""
    def run(spark, d, gold=None):
        return build(spark, d, source(spark, d) if gold is None else gold)
    run.__name__, run.takes_gold = build.__name__, True
    return run


def _on_stored_gold(build: Callable[[SparkSession, str, DataFrame], DataFrame]) -> Callable[..., DataFrame]:
    """A query that reads gold several times: gold is stored first, unless it is handed in."""
    return _on_gold(build, stored_gold)


def _on_staged_gold(build: Callable[[SparkSession, str, DataFrame], DataFrame]) -> Callable[..., DataFrame]:
    """A query that stores gold itself: gold is planned on stored side tables, unless it is handed in."""
    return _on_gold(build, staged_gold)


def _table(name: str) -> Callable[..., DataFrame]:
    wrap = _on_stored_gold if name.startswith("resumo_") else _on_gold
    return wrap(lambda spark, d, gold: order_builders(gold)[name]())


@_on_gold
def q_correlation_grid(spark, d, gold):
    return marts.correlation_grid(gold)


def q_null_profile(spark, d):
    dirty = _dirty(spark, d)
    return profile.null_profile(dirty, clean_movies(dirty, order_by=LINE_ORDER))


@_on_stored_gold
def q_describe_numeric(spark, d, gold):
    desc = profile.describe_numeric(gold)
    return desc.select("coluna", "count", *[rint_round(c, 6).alias(c) for c in
                                             ("mean", "std", "min", "p25", "p50", "p75", "max")])


def q_stage_counters(spark, d, gold=None):
    """Counts of the stages. Gold is built from the same silver, unless it is handed in: each source is parsed once."""
    raw = raw_frames(spark, d)
    s = silver_tables(raw, {"credits": LINE_ORDER, "keywords": LINE_ORDER})
    if gold is None:
        s = {name: write_bucketed(df, scratch_path(spark, f"silver-{name}"), "id") for name, df in s.items()}
        gold = build_gold_dataset(s["clean"], s["directors"], s["keywords"], s["ratings"])
    return profile.stage_counters(raw, s["clean"], s["directors"], s["keywords"], s["ratings"], gold)


q_stage_counters.takes_gold = True


def q_pipeline_counters(spark, d):
    """The counters that a whole run reports (bronze-shaped frames to written outputs)."""
    result = run_frames(
        spark, raw_frames(spark, d), scratch_path(spark, "run"), order_by={"credits": LINE_ORDER, "keywords": LINE_ORDER}, thresholds=TH,
    )
    lost = spark.createDataFrame([("malformadas", k, v) for k, v in result["malformed"].items()], "etapa string, indicador string, valor bigint")
    return result["stage_counters"].unionByName(lost)


@_on_stored_gold
def q_table_row_counts(spark, d, gold):
    return profile.table_row_counts({name: build() for name, build in order_builders(gold).items()})


@_on_stored_gold
def q_raw_vs_gold_record(spark, d, gold):
    return profile.raw_vs_gold(fr.order_movies(spark, d), gold)


@_on_gold
def q_record_by_id(spark, d, gold):
    """Gold stored for look-ups, and the record of its largest id."""
    stored = spark.read.parquet(write_keyed(gold, scratch_path(spark, "gold-keyed")))
    return flat(profile.record_of(stored, stored.agg(F.max("id")).first()[0]))


@_on_stored_gold
def q_highlights(spark, d, gold):
    t = order_builders(gold)
    return profile.highlights(t["receita_por_genero"](), t["top_diretores"](), t["filmes_por_decada"]())


@_on_gold
def q_feed_genre_bars(spark, d, gold):
    return feeds.genre_bars(order_builders(gold)["receita_por_genero"]())


@_on_gold
def q_feed_decade_dual(spark, d, gold):
    return feeds.decade_dual(order_builders(gold)["filmes_por_decada"]())


@_on_gold
def q_feed_cost_revenue(spark, d, gold):
    f = feeds.cost_revenue(gold, TH["feed_min_budget"], TH["feed_min_revenue"])
    return f.select(*[rint_round(c, 6).alias(c) for c in f.columns])


@_on_gold
def q_feed_cost_revenue_max(spark, d, gold):
    return feeds.cost_revenue_max(gold, TH["feed_min_budget"], TH["feed_min_revenue"])


@_on_stored_gold
def q_feed_cost_revenue_binned(spark, d, gold):
    f = feeds.cost_revenue_binned(gold, 20, TH["feed_min_budget"], TH["feed_min_revenue"])
    return f.select("faixa_orcamento", "faixa_receita", "qtd_filmes", rint_round("nota_media", 4).alias("nota_media"),
                    rint_round("largura_mi", 6).alias("largura_mi"))


@_on_gold
def q_feed_corr_matrix(spark, d, gold):
    return feeds.corr_matrix(marts.correlation_grid(gold))


def q_raw_vs_clean_shape(spark, d):
    dirty = _dirty(spark, d).drop("_okey")
    return profile.shapes({"raw": dirty, "clean": clean_movies(dirty, order_by=LINE_ORDER)})


@_on_gold
def q_gold_preview(spark, d, gold):
    return flat(profile.preview(gold, 5, ["id"]))


def q_dirty_dates(spark, d):
    """Dates and collections of a raw export, through cleaning and gold's movie columns."""
    return movie_columns(clean_movies(fr.dirty_dates(fr.order_movies(spark, d)))).select("id", "release_date", "release_year", "decade", "has_collection")


_DIRTY_TEXT = ["id", "title", "adult", "budget", "revenue", "runtime", "belongs_to_collection", "overview"]


def q_csv_ingest(spark, d):
    """Dirty rows written as CSV and read again by the raw reader: header contract, NA tokens, and quotes, commas and line ends in
    fields, the files read in byte ranges."""
    keys = ["l_linenumber", "l_partkey", "l_suppkey"]
    path = write_csv(fr.quoted_titles(fr.dirty_movies(spark, d)).select("_okey", *keys, *_DIRTY_TEXT), scratch_path(spark, "raw-csv"))
    raw = read_raw_csv(spark, path, required=_DIRTY_TEXT)
    return raw.select(F.col("_okey").cast("bigint").alias("l_orderkey"), *[F.col(k).cast("bigint").alias(k) for k in keys], *_DIRTY_TEXT)


@_on_staged_gold
def q_output_manifest(spark, d, gold):
    """Gold is written as Parquet once; the CSV and the tables are read from that output."""
    out = scratch_path(spark, "catalogue-out")
    parquet = write_parquet(gold, f"{out}/filmes_processados_parquet")
    gold = spark.read.parquet(parquet)
    paths = [write_csv(gold, f"{out}/filmes_processados.csv"), parquet]
    tables = write_tables({name: build() for name, build in order_builders(gold).items()}, out)
    return manifest(spark, [*paths, *tables.values()]).select("arquivo", (F.col("bytes") > 0).alias("preenchido"))


@_on_stored_gold
def q_table_csvs(spark, d, gold):
    """Every analytic table through the CSV sink and back: each value, cast to its type again, as a row (table, line, column, value).
    A line is known by its first column, for the correlations by target and feature."""
    built = {name: build() for name, build in order_builders(gold).items()}
    paths = write_tables(built, scratch_path(spark, "tables-csv"))
    parts = []
    for name, table in built.items():
        typed = _read_csv(spark, paths[name]).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        line = F.concat_ws("|", *[F.col(c).cast("string") for c in table.columns[:2 if name == "correlacoes_sucesso" else 1]])
        values = F.array(*[F.struct(F.lit(f.name).alias("coluna"), _value_text(f).alias("valor")) for f in table.schema.fields])
        parts.append(typed.select(F.lit(name).alias("tabela"), line.alias("linha"), F.explode(values).alias("v")).select("tabela", "linha", "v.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _value_text(field: T.StructField) -> F.Column:
    """A value as text that both engines write alike: doubles in whole ten-thousandths."""
    if isinstance(field.dataType, T.DoubleType):
        return F.rint(F.col(field.name) * F.lit(10000.0)).cast("bigint").cast("string")
    return F.col(field.name).cast("string")


def _read_csv(spark, path):
    return spark.read.options(header="true", multiLine="true", quote='"', escape='"').csv(path)


@_on_gold
def q_csv_roundtrip(spark, d, gold):
    """Gold through the CSV sink and back, every column cast to its type again, lists from their JSON text."""
    back = _read_csv(spark, write_csv(gold, scratch_path(spark, "gold-csv")))
    typed = [
        F.from_json(f.name, f.dataType.simpleString()).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast(f.dataType)
        for f in gold.schema.fields
    ]
    return flat(back.select(*typed))


@_on_gold
def q_gold_dtypes(spark, d, gold):
    return profile.gold_dtypes(gold)


@_on_gold
def q_parquet_roundtrip(spark, d, gold):
    # gold through the Parquet sink (directory replaced on every run) and back
    return flat(spark.read.parquet(write_parquet(gold, scratch_path(spark, "gold-roundtrip"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "na_tokens_to_null": q_na_tokens_to_null,
    "source_summary": q_source_summary,
    "clean_ids_keep_first": q_clean_ids_keep_first,
    "clean_counters": q_clean_counters,
    "coerce_numeric": q_coerce_numeric,
    "clean_entities": q_clean_entities,
    "parse_names": q_parse_names,
    "malformed_count": q_malformed_count,
    "first_matching_member": q_first_matching_member,
    "keyword_table": q_keyword_table,
    "rating_bridge": q_rating_bridge,
    "exact_sums": q_exact_sums,
    "gold_dataset": q_gold_dataset,
    "revenue_by_genre": _table("receita_por_genero"),
    "top_directors": _table("top_diretores"),
    "by_decade": _table("filmes_por_decada"),
    "top_keywords": _table("top_palavras_chave"),
    "group_summary_by_genre": _table("resumo_sucesso_por_genero"),
    "group_summary_by_director": _table("resumo_sucesso_por_diretor"),
    "group_summary_by_decade": _table("resumo_sucesso_por_decada"),
    "group_summary_by_keyword": _table("resumo_sucesso_por_palavra_chave"),
    "correlation_grid": q_correlation_grid,
    "top_by_revenue": _table("top_filmes_receita"),
    "top_by_roi": _table("top_filmes_roi"),
    "null_profile": q_null_profile,
    "describe_numeric": q_describe_numeric,
    "stage_counters": q_stage_counters,
    "table_row_counts": q_table_row_counts,
    "raw_vs_gold_record": q_raw_vs_gold_record,
    "record_by_id": q_record_by_id,
    "highlights": q_highlights,
    "feed_genre_bars": q_feed_genre_bars,
    "feed_decade_dual": q_feed_decade_dual,
    "feed_cost_revenue": q_feed_cost_revenue,
    "feed_cost_revenue_max": q_feed_cost_revenue_max,
    "feed_cost_revenue_binned": q_feed_cost_revenue_binned,
    "feed_corr_matrix": q_feed_corr_matrix,
    "raw_vs_clean_shape": q_raw_vs_clean_shape,
    "gold_preview": q_gold_preview,
    "output_manifest": q_output_manifest,
    "dirty_dates": q_dirty_dates,
    "csv_ingest": q_csv_ingest,
    "csv_roundtrip": q_csv_roundtrip,
    "table_csvs": q_table_csvs,
    "pipeline_counters": q_pipeline_counters,
    "gold_dtypes": q_gold_dtypes,
    "parquet_roundtrip": q_parquet_roundtrip,
}
