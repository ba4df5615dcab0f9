"""Analytic tables on a small hand-made gold frame, and the exact quantile operator."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from goldmart.constants import GOLD_COLUMNS
from goldmart.operators import marts
from goldmart.operators.quantiles import _selected, grouped_quantiles

GOLD_SCHEMA = (
    "id bigint, title string, primary_genre string, genres_list array<string>, director string, "
    "primary_keyword string, keywords_list array<string>, keyword_count bigint, budget double, revenue double, "
    "profit double, roi double, vote_average double, vote_count double, user_rating_avg double, "
    "user_rating_count bigint, popularity double, runtime double, original_language string, release_date string, "
    "release_year int, decade int, has_collection int, overview string, status string"
)


def gold_row(i, genre, director, revenue, budget, roi, vote, votes, rating, runtime, decade, keywords):
    return (i, f"t{i}", genre, [genre] if genre else [], director, keywords[0] if keywords else None, keywords,
            len(keywords), budget, revenue, None if revenue is None or budget is None else revenue - budget, roi,
            vote, votes, rating, 1 if rating is not None else None, 1.0, runtime, "en", None, None, decade, 0, "", "R")


@pytest.fixture()
def gold(spark):
    rows = [
        gold_row(1, "A", "d1", 1e9, 1e8, 900.0, 7.0, 200.0, 4.0, 100.0, 1990, ["x", "y"]),
        gold_row(2, "A", "d1", 2e9, 5e8, 300.0, 6.0, 50.0, 3.0, 120.0, 1990, ["x"]),
        gold_row(3, "A", "d1", 4e9, 2e9, 100.0, 8.0, None, None, 90.0, 2000, ["x", "x"]),
        gold_row(4, "B", "d2", 10e9, 1e9, 900.0, 5.0, 1000.0, 2.0, 80.0, 2000, []),
        gold_row(5, "B", "d2", None, 1e6, None, 9.0, 100.0, 5.0, 60.0, 2000, ["y"]),
        gold_row(6, None, "d2", 3e9, None, None, 4.0, 100.0, 1.0, 100.0, None, ["z"]),
    ]
    return spark.createDataFrame(rows, GOLD_SCHEMA)


def test_gold_fixture_has_contract_columns(gold):
    assert gold.columns == GOLD_COLUMNS


def test_revenue_by_genre(gold):
    rows = [r.asDict() for r in marts.revenue_by_genre(gold).collect()]
    assert rows == [
        {"primary_genre": "B", "receita_total_bi": 10.0, "receita_media_mi": 10000.0, "qtd_filmes": 1},
        {"primary_genre": "A", "receita_total_bi": 7.0, "receita_media_mi": 2333.33, "qtd_filmes": 3},
    ]


def test_top_directors_having(gold):
    rows = marts.top_directors(gold, min_count=2).collect()
    assert [(r.director, r.qtd_filmes) for r in rows] == [("d2", 2), ("d1", 3)]
    assert marts.top_directors(gold, min_count=3).count() == 1


def test_movies_by_decade_sorted_and_revenue_free(gold):
    rows = marts.movies_by_decade(gold).collect()
    assert [(r.decade, r.qtd_filmes) for r in rows] == [(1990, 2), (2000, 3)]
    assert rows[1].nota_usuarios_media == 3.5  # mean of 2.0 and 5.0 (null skipped)


def test_top_keywords_counts_repeats(gold):
    rows = {r.keyword: r for r in marts.top_keywords(gold, min_count=1).collect()}
    assert rows["x"].qtd_filmes == 4  # 'x' twice in movie 3 counts twice
    assert rows["y"].qtd_filmes == 2 and rows["y"].receita_media_mi == 1000.0  # revenue of movie 5 is null


def test_group_summary_median_and_order(gold):
    rows = marts.group_summary(gold, "director", 1).collect()
    assert [r.director for r in rows] == ["d2", "d1"]
    d1 = rows[1]
    assert (d1.qtd_filmes, d1.receita_total_bi, d1.receita_mediana_mi) == (3, 7.0, 2000.0)
    assert rows[0].receita_mediana_mi == 6500.0  # (10e9 + 3e9) / 2
    assert marts.group_summary(gold, "director", 3).count() == 1


def test_group_summary_selection_equals_local_sort(gold):
    a = {r.director: r.receita_mediana_mi for r in marts.group_summary(gold, "director", 1, local_rows=0).collect()}
    b = {r.director: r.receita_mediana_mi for r in marts.group_summary(gold, "director", 1).collect()}
    assert a == b == {"d1": 2000.0, "d2": 6500.0}


def test_group_summary_approx_option(gold):
    rows = {r.director: r for r in marts.group_summary(gold, "director", 1, median="approx").collect()}
    assert rows["d1"].receita_mediana_mi == 2000.0


def test_correlation_grid(spark, gold):
    rows = marts.correlation_grid(gold).collect()
    assert len(rows) == 12
    assert [r.target for r in rows[:6]] == ["revenue"] * 6
    for r in rows:
        assert r.correlation is None or -1.0 <= r.correlation <= 1.0
    pdf = gold.toPandas()
    for r in rows:
        pair = pdf[[r.feature, r.target]].dropna()
        assert r.sample_size == len(pair)
        exp = pair[r.feature].corr(pair[r.target]) if len(pair) >= 2 else float("nan")
        if exp != exp:
            assert r.correlation is None
        else:
            assert r.correlation == pytest.approx(round(exp, 4), abs=1e-12)


def test_correlation_zero_variance_and_tiny_samples(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 3.0, None)], "budget double, revenue double, roi double")
    df = df.selectExpr("*", "1.0 as popularity", "1.0 as vote_average", "1.0 as vote_count",
                       "1.0 as user_rating_avg", "1.0 as runtime")
    rows = {(r.target, r.feature): r for r in marts.correlation_grid(df).collect()}
    assert rows[("revenue", "budget")].correlation is None  # zero variance
    assert rows[("roi", "budget")].sample_size == 1 and rows[("roi", "budget")].correlation is None
    empty = marts.correlation_grid(df.where("false")).collect()
    assert len(empty) == 12 and all(r.sample_size == 0 and r.correlation is None for r in empty)


def test_top_films(gold):
    top = marts.top_films_by_revenue(gold, limit=2, min_votes=100).collect()
    assert [r.title for r in top] == ["t4", "t6"]  # t2 has 50 votes, t3 none (counts as 0)
    top3 = marts.top_films_by_revenue(gold, limit=3, min_votes=100).collect()
    assert [r.title for r in top3] == ["t4", "t6", "t1"]
    roi = marts.top_films_by_roi(gold, limit=5, min_votes=0, min_budget=1e8).collect()
    assert [r.title for r in roi] == ["t1", "t4", "t2", "t3"]  # ties on 900 broken by id


def test_build_aggregations_names(gold):
    tables = marts.build_aggregations(gold)
    assert list(tables) == [
        "receita_por_genero", "top_diretores", "filmes_por_decada", "top_palavras_chave", "correlacoes_sucesso",
        "top_filmes_receita", "top_filmes_roi", "resumo_sucesso_por_genero", "resumo_sucesso_por_diretor",
        "resumo_sucesso_por_decada", "resumo_sucesso_por_palavra_chave",
    ]
    assert tables["resumo_sucesso_por_genero"].columns == [
        "primary_genre", "qtd_filmes", "receita_total_bi", "receita_media_mi", "receita_mediana_mi", "roi_medio",
        "nota_metadata_media", "nota_usuarios_media",
    ]


def _median(df, **kw):
    return grouped_quantiles(df, ["k"], "v", [0.5], ["median"], midpoint_mean=True, **kw)


@pytest.mark.parametrize("local_rows", [0, 3, 100])
def test_quantiles_fixture_values(spark, local_rows):
    df = spark.createDataFrame([(1, v) for v in (1.0, 2.0, 4.0, 10.0)], "k int, v double")
    row = grouped_quantiles(df, ["k"], "v", [0.25, 0.5, 0.75], local_rows=local_rows).first()
    assert (row.q0, row.q1, row.q2) == (1.75, 3.0, 5.5)
    assert _median(df, local_rows=local_rows).first().median == 3.0
    assert _median(df, local_rows=local_rows, min_count=5).count() == (0 if local_rows >= 4 else 1)


@pytest.mark.parametrize("local_rows", [0, 1000, 100_000])
def test_quantiles_match_pandas_with_hot_key(spark, local_rows):
    rng = np.random.default_rng(7)
    n = 20000
    keys = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    vals = np.round(rng.lognormal(8, 2, n), 2)
    vals[rng.random(n) < 0.05] = np.nan
    vals[keys == 3] = 5.0  # a group of one value
    pdf = pd.DataFrame({"k": keys, "v": vals})
    df = spark.createDataFrame(pdf).repartition(6)
    got = _median(df, local_rows=local_rows).toPandas().set_index("k")["median"].sort_index()
    exp = pdf.groupby("k")["v"].median().sort_index()
    assert np.allclose(got.values, exp.values, rtol=0, atol=1e-9)
    q = grouped_quantiles(df, ["k"], "v", [0.1, 0.25, 0.75, 0.9], local_rows=local_rows).where("k = 0").first()
    expq = pdf[pdf.k == 0].v.quantile([0.1, 0.25, 0.75, 0.9]).tolist()
    assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(q[1:], expq))


def test_quantiles_with_many_small_groups_and_an_empty_table(spark):
    df = spark.range(40_000).selectExpr("cast(id % 10000 as int) as k", "cast(id div 10000 as double) as v")
    assert {r.median for r in _median(df).collect()} == {1.5} and _median(df).count() == 10_000
    assert _median(df.limit(0)).count() == 0


def test_quantile_plan_does_not_exchange_values_on_the_bare_group(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as int) as k", "cast(id as double) as v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = df.select("k", F.col("v").alias("_v"))
        plan = _selected(rows, ["k"], [0.5], ["m"], True, 8, 10000)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "_salt" in plan and len(plan) < 60_000


def test_rows_of_large_groups_are_never_the_side_that_is_broadcast(spark):
    """The rows look small to the planner (few bytes a row), the bounds do not: still the rows stay where they are dealt to."""
    from goldmart.operators.quantiles import LOCAL_ROWS, SALTS

    n = 3 * LOCAL_ROWS
    df = spark.range(n).select((F.col("id") % 2).cast("int").alias("k"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("double").alias("v"))
    found = grouped_quantiles(df, ["k"], "v", [0.5], ["m"], midpoint_mean=True)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    # by (group, salt) the rows meet the sizes, the bounds and the hit buckets; only joins with these may broadcast, and only the right side
    assert SALTS > 1 and "BuildLeft" not in plan and "ShuffledHashJoin" in plan
    assert "aggregate(" not in plan.split("_before")[0]
    values = df.toPandas()
    for row in found.collect():
        assert row["m"] == values.v[values.k == row["k"]].median()
