"""A key holding a third of all rows: results stay whole and exact, and the map side shrinks it
(partial window limit / partial aggregates) before any shuffle."""

import random

from pyspark.sql import functions as F

from goldmart.operators import marts
from goldmart.operators.dedup import keep_first
from goldmart.operators.silver import build_movie_ratings


def test_keep_first_with_hot_key(spark):
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.34 else rnd.randint(1, 500), i, rnd.random()) for i in range(30000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, p int, v double").repartition(8)
    got = {r.k: r.p for r in keep_first(df, ["k"], ["p"]).collect()}
    exp = {}
    for k, p, _ in rows:
        exp[k] = min(p, exp.get(k, p))
    assert got == exp


def test_rating_bridge_with_hot_movie(spark):
    rnd = random.Random(9)
    ratings = [(str(rnd.randint(1, 50)), "1" if rnd.random() < 0.34 else str(rnd.randint(2, 300)),
                str(rnd.randint(1, 10) / 2), "0") for _ in range(20000)]
    links = [(str(m), str(m // 3), m) for m in range(1, 301)]
    r = spark.createDataFrame(ratings, "userId string, movieId string, rating string, timestamp string").repartition(8)
    l = spark.createDataFrame(links, "movieId string, tmdbId string, _pos int")
    got = {x.id: (x.user_rating_avg, x.user_rating_count) for x in build_movie_ratings(l, r).collect()}
    sums, counts = {}, {}
    for _, m, v, _ in ratings:
        t = int(m) // 3
        sums[t] = sums.get(t, 0.0) + float(v)
        counts[t] = counts.get(t, 0) + 1
    assert {t: c for t, (_, c) in got.items()} == counts
    for t, (avg, _) in got.items():
        assert abs(avg - round(sums[t] / counts[t], 2)) < 1e-9


def test_keyword_summary_with_hot_keyword(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(6000):
        kws = ["hot"] if rnd.random() < 0.34 else [f"k{rnd.randint(1, 30)}"]
        rows.append((i, float(rnd.randint(1, 1000)) * 1000, kws))
    gold = spark.createDataFrame(rows, "id bigint, revenue double, keywords_list array<string>").select(
        "id", "revenue", "keywords_list", F.lit(None).cast("double").alias("roi"),
        F.lit(1.0).alias("vote_average"), F.lit(2.0).alias("user_rating_avg"))
    got = {r.keyword: r for r in marts.keyword_summary(gold, 1).collect()}
    hot = sorted(v for _, v, k in rows if k == ["hot"])
    n = len(hot)
    med = (hot[(n - 1) // 2] + hot[n // 2]) / 2
    assert got["hot"].qtd_filmes == n
    assert got["hot"].receita_mediana_mi == round(med / 1e6, 2)
    assert sum(r.qtd_filmes for r in got.values()) == 6000
