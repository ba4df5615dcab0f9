"""Data-quality and inspection views: null profile, numeric description, shapes, counters,
record comparison, dtypes and highlights. Each is one small aggregate over the inputs; nothing
but counters and names reaches the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.constants import BRONZE_COLUMNS
from goldmart.functions.numeric import to_double
from goldmart.operators.quantiles import grouped_quantiles


def visible(columns: Sequence[str]) -> list[str]:
    """The source's own columns: all but those that bronze landing adds."""
    return [c for c in columns if c not in BRONZE_COLUMNS]


def _null_counts(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "coluna", label)


def null_profile(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(coluna, raw, clean): missing values per shared column, before and after cleaning; only
    columns where either side has some; sorted by raw then clean, descending."""
    shared = [c for c in visible(raw.columns) if c in set(clean.columns)]
    joined = _null_counts(raw, shared, "raw").join(_null_counts(clean, shared, "clean"), "coluna")
    return (
        joined.where((F.col("raw") > 0) | (F.col("clean") > 0))
        .orderBy(F.desc("raw"), F.desc("clean"), F.asc("coluna"))
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in BRONZE_COLUMNS]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(coluna, count, mean, std, min, p25, p50, p75, max) per numeric column: sample std and
    exact linearly interpolated quartiles (``percentile_approx``/``summary()`` are approximate).
    The simple measures are one wide aggregate; the columns are unpivoted only for the quartiles, where they are
    the groups of one distributed selection."""
    cols = list(columns) if columns else numeric_columns(df)
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = wide.agg(*[fn(c).alias(f"{m}_{i}") for i, c in enumerate(cols) for m, fn in measures.items()])
    simple = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), *[F.col(f"{m}_{i}").alias(m) for m in measures]) for i, c in enumerate(cols)
    ])).alias("r")).select("r.*")
    long = wide.unpivot([], cols, "coluna", "valor")
    quart = grouped_quantiles(long, ["coluna"], "valor", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return simple.join(quart, "coluna", "left").select(
        "coluna", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def shapes(frames: Mapping[str, DataFrame], files: Mapping[str, str] | None = None) -> DataFrame:
    """(dataset, [arquivo,] linhas, colunas) per frame: one count per frame, unioned."""
    parts = []
    for name, df in frames.items():
        cols = [F.lit(name).alias("dataset")]
        if files is not None:
            cols.append(F.lit(files.get(name)).alias("arquivo"))
        parts.append(
            df.agg(F.count(F.lit(1)).alias("linhas")).select(
                *cols, "linhas", F.lit(len(visible(df.columns))).cast("bigint").alias("colunas")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ("id",)) -> DataFrame:
    """First ``n`` rows in a stated order (each task keeps its own top ``n``)."""
    return df.orderBy(*order_by).limit(n)


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, linhas) per analytic table."""
    parts = [t.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(n).alias("tabela"), "linhas") for n, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage_counters(
    raw: Mapping[str, DataFrame],
    clean_movies: DataFrame,
    directors: DataFrame,
    keywords: DataFrame,
    ratings: DataFrame,
    gold: DataFrame,
    movies_key: str = "movies",
    raw_rows: Mapping[str, int] | None = None,
) -> DataFrame:
    """(etapa, indicador, valor): the pipeline's stage counters as rows. ``raw_rows``: rows per source, if they are known already."""
    def one(etapa: str, name: str, df: DataFrame, measure=None) -> DataFrame:
        m = F.count(F.lit(1)) if measure is None else measure
        return df.agg(m.cast("bigint").alias("valor")).select(F.lit(etapa).alias("etapa"), F.lit(name).alias("indicador"), "valor")

    spark = gold.sparkSession
    fixed = spark.createDataFrame(
        [("fontes", "quantidade_arquivos", len(raw)), ("ingestao", "dataset_lidos", len(raw)),
         ("transformacao", "dataset_gold_colunas", len(gold.columns))],
        "etapa string, indicador string, valor bigint",
    )
    # one count per source; the total and the movies are read off these few rows
    counts = shapes(raw) if raw_rows is None else spark.createDataFrame(list(raw_rows.items()), "dataset string, linhas bigint")
    sources = counts.agg(
        F.sum("linhas").cast("bigint").alias("total"), F.max(F.when(F.col("dataset") == movies_key, F.col("linhas"))).alias("movies")
    )
    lines = sources.select(F.explode(F.array(
        F.struct(F.lit("ingestao").alias("etapa"), F.lit("total_linhas_brutas").alias("indicador"), F.col("total").alias("valor")),
        F.struct(F.lit("transformacao").alias("etapa"), F.lit("movies_linhas_brutas").alias("indicador"), F.col("movies").alias("valor")),
    )).alias("r")).select("r.*")
    parts = [
        fixed,
        lines,
        one("transformacao", "movies_linhas_apos_limpeza", clean_movies),
        one("transformacao", "diretores_extraidos", directors),
        one("transformacao", "filmes_com_palavras_chave", keywords, F.count_if(F.col("keyword_count") > 0)),
        one("transformacao", "filmes_com_ratings", ratings),
        one("transformacao", "dataset_gold_linhas", gold),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_id(gold: DataFrame, order_by: str = "id") -> DataFrame:
    """One row (id): the first movie (by ``order_by``) with director, primary keyword and user
    rating, else the first movie. A single global aggregate, no sort."""
    full = F.col("director").isNotNull() & F.col("primary_keyword").isNotNull() & F.col("user_rating_avg").isNotNull()
    order = F.col(order_by)
    return gold.agg(
        F.coalesce(F.min_by("id", F.when(full, order)), F.min_by("id", order)).alias("id")
    )


def record_of(table: DataFrame, value, key: str = "id") -> DataFrame:
    """The rows of one key. The comparison with a plain value reaches the scan, which skips the row groups whose bounds or bloom
    filter exclude it (tables written by ``write_keyed``)."""
    return table.where(F.col(key) == F.lit(value))


def _as_text(df: DataFrame, digits: int = 4) -> DataFrame:
    """Every column as text; doubles with a fixed number of decimals, lists joined by ', '."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            scale = float(10 ** digits)
            c = F.when(c.isNotNull(), F.format_string(f"%.{digits}f", F.rint(c * F.lit(scale)) / F.lit(scale)))
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ", ")
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def raw_vs_gold(raw: DataFrame, gold: DataFrame, order_by: str = "id", raw_order: str = "_pos") -> DataFrame:
    """(campo, raw, gold): one movie side by side, raw text against gold values, joined on the
    field name (full outer: fields only one side has get a null on the other)."""
    pick = sample_id(gold, order_by)
    raw_cols = visible(raw.columns)
    raw_num = raw.withColumn("_num", to_double(raw, "id"))
    raw_row = (
        raw_num.join(F.broadcast(pick.select(F.col("id").cast("double").alias("_num"))), "_num", "left_semi")
        .agg(F.min_by(F.struct(*[F.col(c) for c in raw_cols]), F.col(raw_order)).alias("r"))
        .select("r.*")
    )
    raw_row = _as_text(raw_row)
    gold_row = _as_text(gold.join(F.broadcast(pick), "id", "left_semi"))
    raw_long = raw_row.unpivot([], raw_cols, "campo", "raw")
    gold_long = gold_row.unpivot([], gold_row.columns, "campo", "gold")
    return raw_long.join(gold_long, "campo", "full_outer")


def gold_dtypes(df: DataFrame) -> DataFrame:
    """(posicao, coluna, tipo, nao_nulos): column order, type and non-null count, from one
    aggregate over the data (the type names come from the schema)."""
    rows = [
        F.struct(
            F.lit(i).alias("posicao"),
            F.lit(f.name).alias("coluna"),
            F.lit(f.dataType.simpleString()).alias("tipo"),
            F.col(f"_n{i}").alias("nao_nulos"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"_n{i}") for i, f in enumerate(df.schema.fields)])
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def highlights(receita_por_genero: DataFrame, top_diretores: DataFrame, filmes_por_decada: DataFrame) -> DataFrame:
    """One row: leading genre and director by total revenue, busiest decade (null when the
    table is empty). Global aggregates, so empty tables still give the row."""
    genre = receita_por_genero.agg(
        F.min_by("primary_genre", F.struct(-F.col("receita_total_bi"), F.col("primary_genre"))).alias("genero_lider_receita")
    )
    director = top_diretores.agg(
        F.min_by("director", F.struct(-F.col("receita_total_bi"), F.col("director"))).alias("diretor_lider_receita")
    )
    dec = filmes_por_decada.agg(
        F.min_by("decade", F.struct(-F.col("qtd_filmes"), F.col("decade"))).cast("int").alias("decada_com_mais_filmes")
    )
    names = ["genero_lider_receita", "diretor_lider_receita", "decada_com_mais_filmes"]
    typed = {"genero_lider_receita": "string", "diretor_lider_receita": "string", "decada_com_mais_filmes": "int"}

    def widen(df, name):
        return df.select(*[F.col(n) if n == name else F.lit(None).cast(typed[n]).alias(n) for n in names])

    # three one-row aggregates stacked and folded into one row: no join
    stacked = widen(genre, names[0]).unionByName(widen(director, names[1])).unionByName(widen(dec, names[2]))
    return stacked.agg(*[F.max(n).alias(n) for n in names])

