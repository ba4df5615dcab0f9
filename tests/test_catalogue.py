"""Every catalogue query against its DuckDB oracle on the smallest TESTDATA scale, compared the
way the driver does (columns by name, rows as a multiset), plus plan shapes that matter at scale."""

import math
import os
import shutil

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from goldmart.operators import marts
from goldmart.plans.catalogue import QUERIES, stored_gold
from goldmart.plans.oracle import SQL
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = duck.execute(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(exp)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "primary_genre" and df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cartesian_products(spark):
    gold = stored_gold(spark, SF_SMALL)
    for name, fn in QUERIES.items():
        if name in ("parquet_roundtrip", "output_manifest", "csv_roundtrip", "table_csvs", "pipeline_counters", "stage_counters"):
            continue  # these write first
        plan = _plan(fn(spark, SF_SMALL, **({"gold": gold} if getattr(fn, "takes_gold", False) else {})))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_top_n_is_take_ordered(spark):
    plan = _plan(E.queries()["top_by_revenue"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_scans_are_pruned(spark):
    gold = stored_gold(spark, SF_SMALL)
    plan = _plan(QUERIES["revenue_by_genre"](spark, SF_SMALL, gold=gold))
    assert "ReadSchema: struct<id:bigint,primary_genre:string,revenue:double>" in plan


def test_having_drops_directors(spark):
    gold = stored_gold(spark, SF_SMALL)
    assert QUERIES["top_directors"](spark, SF_SMALL, gold=gold).count() < marts.top_directors(gold, 1).count()


def test_a_replaced_input_gives_its_own_answer(spark, tmp_dir):
    for t in TABLES:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    before = E.queries()["by_decade"](spark, tmp_dir).agg({"qtd_filmes": "sum"}).first()[0]
    half = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 2 = 0").toPandas()
    spark.createDataFrame(half).coalesce(1).write.mode("overwrite").parquet(f"{tmp_dir}/half")
    part = next(f for f in os.listdir(f"{tmp_dir}/half") if f.endswith(".parquet"))
    os.remove(f"{tmp_dir}/orders.parquet")
    shutil.copy(f"{tmp_dir}/half/{part}", f"{tmp_dir}/orders.parquet")
    spark.catalog.clearCache()
    after = E.queries()["by_decade"](spark, tmp_dir).agg({"qtd_filmes": "sum"}).first()[0]
    assert 0 < after < before
