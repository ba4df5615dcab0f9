"""CSV ingest contracts, ragged rows, sinks and the end-to-end run on the hand-written movies."""

import os

import pytest
from pyspark.sql import functions as F

from goldmart.constants import GOLD_COLUMNS, TABLE_NAMES
from goldmart.plans.pipeline import run
from goldmart.sources.bronze import RaggedRowError, land_bronze, read_raw_csv
from goldmart.sources.contracts import ContractError, require_files


def write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_multiline_quotes_na_and_position(spark, tmp_dir):
    p = os.path.join(tmp_dir, "m.csv")
    write(p, 'id,title,overview\n1,"A ""quoted"" title","line one\nline two"\n2,NA,\n3,x,None\n')
    rows = read_raw_csv(spark, p).orderBy("_pos").collect()
    assert [r.id for r in rows] == ["1", "2", "3"]
    assert rows[0].title == 'A "quoted" title' and rows[0].overview == "line one\nline two"
    assert rows[1].title is None and rows[1].overview is None and rows[2].overview is None


def test_csv_header_order_is_respected(spark, tmp_dir):
    p = os.path.join(tmp_dir, "links.csv")
    write(p, "tmdbId,movieId\n10,1\n")
    r = read_raw_csv(spark, p, "links").first()
    assert (r.movieId, r.tmdbId) == ("1", "10")


def test_csv_contract_checked_on_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "credits.csv")
    write(p, "id,cast\n1,x\n")
    with pytest.raises(ContractError, match="crew"):
        read_raw_csv(spark, p, "credits")


def test_ragged_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.csv")
    write(p, 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y",2,3\n')
    with pytest.raises(RaggedRowError, match="1 rows"):
        land_bronze(spark, p, os.path.join(tmp_dir, "b1"))
    kept = land_bronze(spark, p, os.path.join(tmp_dir, "b2"), on_long_row="quarantine").orderBy("_pos").collect()
    assert [(r.a, r.b, r.c) for r in kept] == [("1", "2", "3"), ("4", "5", None), ("x,y", "2", "3")]
    flagged = spark.read.parquet(os.path.join(tmp_dir, "b2")).where("_long").count()
    assert flagged == 1


def test_columns_that_begin_with_an_underscore_are_the_users(spark, tmp_dir):
    from goldmart.operators import profile

    p = os.path.join(tmp_dir, "u.csv")
    write(p, "id,_n1,_n2,title\n1,n/a,NA,x\n2,a,b\n3,,c,d\n")
    rows = land_bronze(spark, p, os.path.join(tmp_dir, "u"))
    assert [(r.id, r["_n1"], r["_n2"], r.title) for r in rows.orderBy("_pos").collect()] == [
        ("1", None, None, "x"), ("2", "a", "b", None), ("3", None, "c", "d")]
    assert profile.shapes({"u": rows}).first()["colunas"] == 4
    assert {r.coluna: r.raw for r in profile.null_profile(rows, rows).collect()} == {"_n1": 2, "_n2": 1, "title": 1}
    write(os.path.join(tmp_dir, "c.csv"), "id,_pos\n1,2\n")
    with pytest.raises(ContractError, match="_pos"):
        read_raw_csv(spark, os.path.join(tmp_dir, "c.csv"))


def test_a_very_long_quoted_record_is_counted_in_linear_time(spark, tmp_dir):
    from goldmart.sources.bronze import field_count

    record = ",".join(f'"v,{i} ""q"""' for i in range(100_000))
    df = spark.createDataFrame([(record,), ('a,"b\nc",d',), ("a",)], "_corrupt string")
    assert [r[0] for r in df.select(field_count()).collect()] == [100_000, 3, 1]
    p = os.path.join(tmp_dir, "long.csv")
    write(p, "a,b\n1,2\n" + ",".join(['"x,y"'] * 5000) + "\n")
    with pytest.raises(RaggedRowError, match="1 rows"):
        land_bronze(spark, p, os.path.join(tmp_dir, "bl"))


def test_missing_files_named_together(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "raw"))
    write(os.path.join(tmp_dir, "raw", "links.csv"), "movieId,tmdbId\n")
    with pytest.raises(FileNotFoundError) as e:
        require_files(spark, os.path.join(tmp_dir, "raw"))
    assert "credits.csv, keywords.csv, movies_metadata.csv, ratings_small.csv" in str(e.value)


def test_end_to_end(spark, raw_dir, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    with pytest.warns(RuntimeWarning):
        res = run(spark, raw_dir, out)
    gold = res["gold"]
    assert gold.columns == GOLD_COLUMNS
    rows = {r.id: r for r in gold.collect()}
    assert set(rows) == {1, 6, 7, 8, 16, 17, 18, 19}
    assert gold.select("id").distinct().count() == len(rows)
    toy = rows[1]
    assert (toy.profit, toy.roi, toy.primary_genre, list(toy.genres_list)) == (150.0, 150.0, "Animation", ["Animation", "Comedy"])
    assert (toy.director, toy.primary_keyword, toy.keyword_count) == ("John Lasseter", "jealousy", 3)
    assert (toy.user_rating_avg, toy.user_rating_count, toy.has_collection) == (4.0, 3, 1)
    assert (toy.release_date, toy.release_year, toy.decade) == ("1999-12-31", 1999, 1990)
    six = rows[6]
    assert six.roi is None and six.profit == 305.0 and six.decade == 2000 and six.keyword_count == 0
    assert rows[7].release_date == "1995-01-05" and rows[7].director == "Terence Young" and rows[7].user_rating_avg == 2.5
    assert rows[8].release_date is None and rows[8].director is None
    assert rows[16].release_date is None and list(rows[16].genres_list) == ["Drama"]
    assert rows[17].release_date is None and list(rows[17].genres_list) == [] and rows[17].primary_genre is None
    assert rows[18].has_collection == 0 and rows[18].keyword_count == 0 and list(rows[18].keywords_list) == []
    assert rows[19].vote_count is None and rows[19].keywords_list == []
    assert res["malformed"] == {"credits.crew": 1, "keywords.keywords": 1, "movies.genres": 1}

    tables = res["tables"]
    assert list(tables) == TABLE_NAMES
    corr = tables["correlacoes_sucesso"].collect()
    assert len(corr) == 12 and all(r.correlation is None or -1 <= r.correlation <= 1 for r in corr)
    by_genre = tables["receita_por_genero"].collect()
    with_genre_revenue = gold.where(F.col("primary_genre").isNotNull() & F.col("revenue").isNotNull()).count()
    assert sum(r.qtd_filmes for r in by_genre) == with_genre_revenue

    # files: gold parquet round trip, every table as CSV, manifest lists them
    back = spark.read.parquet(res["paths"]["filmes_processados_parquet"])
    assert sorted(map(tuple, back.select("id", "title", "roi").collect())) == sorted(
        map(tuple, gold.select("id", "title", "roi").collect()))
    assert os.path.exists(os.path.join(res["paths"]["filmes_processados_parquet"], "_SUCCESS"))
    for name in TABLE_NAMES:
        assert os.path.isdir(res["paths"][name])
    csv_gold = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(res["paths"]["filmes_processados_csv"])
    assert csv_gold.count() == len(rows)
    files = {f.arquivo: f.bytes for f in res["manifest"].collect()}
    assert set(files) == {"filmes_processados.csv", "filmes_processados_parquet", *[f"{t}.csv" for t in TABLE_NAMES]}
    assert all(size > 0 for size in files.values())
    assert res["stage_summary"]["transformacao"]["dataset_gold_linhas"] == len(rows)
    assert res["stage_summary"]["transformacao"]["dataset_gold_colunas"] == 25
    assert [d["dataset"] for d in res["source_summary"]] == ["movies", "credits", "keywords", "links", "ratings"]
    views = res["views"]
    top = views["destaques"].first()
    assert top.genero_lider_receita is not None and top.decada_com_mais_filmes in (1990, 2000)
    assert {r.tabela: r.linhas for r in views["linhas_por_tabela"].collect()}["correlacoes_sucesso"] == 12
    assert views["tipos_das_colunas"].count() == 25
    assert views["estatisticas_numericas"].where("coluna = 'id'").first()["count"] == len(rows)
    missing = {r.coluna: (r.raw, r.clean) for r in views["valores_ausentes"].collect()}
    assert missing["id"][1] == 0 and missing["id"][0] >= 1
    fields = {r.campo for r in views["registro_bruto_vs_final"].collect()}
    assert {"id", "genres", "primary_genre"} <= fields


def test_keep_first_across_files_follows_file_order(spark, tmp_dir):
    d = os.path.join(tmp_dir, "movies")
    os.makedirs(d)
    header = "id,title,adult,budget,revenue,runtime,genres,belongs_to_collection,vote_average,vote_count,popularity,original_language,release_date,overview,status\n"
    write(os.path.join(d, "part-a.csv"), header + "1,First,False,1,2,90,[],,1,1,1,en,1995-01-01,x,R\n2,Only A,False,1,2,90,[],,1,1,1,en,1995-01-01,x,R\n")
    write(os.path.join(d, "part-b.csv"), header + "1,Second,False,1,2,90,[],,1,1,1,en,1995-01-01,x,R\n3,Only B,False,1,2,90,[],,1,1,1,en,1995-01-01,x,R\n")
    from goldmart.operators.clean import clean_movies
    bronze = land_bronze(spark, d, os.path.join(tmp_dir, "bronze"), "movies")
    got = {r.id: r.title for r in clean_movies(bronze).collect()}
    assert got == {1: "First", 2: "Only A", 3: "Only B"}
