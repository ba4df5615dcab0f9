import random

import numpy as np
from pyspark.sql import functions as F

from goldmart.llm import toxicity
from goldmart.llm.chargrams import TokenCache

BAD = ["scumbag", "worthless", "pathetic", "moronic", "idiotic"]


def corpus(n=600, seed=4, words=None):
    rng = random.Random(seed)
    syllables = ["ra", "ti", "on", "be", "lo", "mu", "se", "da", "ki", "ver", "an", "is"]
    rows = []
    for i in range(n):
        text = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.choice([5, 30, 120, 400]))]
        toxic = int(rng.random() < 0.35)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text) + 1), rng.choice(words or BAD))
        rows.append((i, " ".join(text), toxic))
    return rows


def fitted(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return docs, toxicity.learn(docs, labels, F.lit(True))


def test_learns_words_finds_misspellings_and_long_texts(spark):
    docs, model = fitted(spark, corpus())
    test = corpus(300, seed=9)
    clean = " ".join(corpus(1, seed=2, words=["x"])[0][1].split()[:30]) + " ration bela muse "
    odd = [(1000, None), (1001, ""), (1002, " \n"), (1003, "raon " * 50_000), (1004, "raon " * 50_000 + "worthless " + "bela " * 50_000),
           (1005, clean + "Worthles!"), (1006, clean + "PATHETICC"), (1007, "!!! ??"), (1008, "moronic")]
    df = spark.createDataFrame([r[:2] for r in test] + odd, "doc_id long, text string").withColumns({"Score": F.lit("x"), "label": F.lit(0)})
    rows = {r["doc_id"]: r for r in toxicity.score_texts(df, model).collect()}
    truth = {r[0]: r[2] for r in test}
    assert np.mean([rows[i]["predicted"] == y for i, y in truth.items()]) >= 0.97
    assert [rows[i]["predicted"] for i in range(1000, 1009)] == [0, 0, 0, 0, 1, 1, 1, 0, 1]
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[1000]["score"] == rows[1001]["score"] == rows[1002]["score"]


def test_no_labels_one_class_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        model = toxicity.learn(docs, some, F.lit(True))
        assert model is None
        assert [r["score"] for r in toxicity.score_texts(docs, model).collect()] == [0.0, 0.0]
    assert toxicity.score_texts(docs.limit(0), None).count() == 0


def test_one_toxic_id_on_most_rows_fits_a_model(spark):
    rows = corpus(400, seed=3)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, f"you worthless {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(900, 1)] * 3, "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, F.lit(True), max_toxic=100, max_clean=200)
    assert model is not None
    test = spark.createDataFrame([r[:2] for r in corpus(200, seed=8)], "doc_id long, text string")
    truth = {r[0]: r[2] for r in corpus(200, seed=8)}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in toxicity.score_texts(test, model).collect()]) >= 0.95


def test_windows_overlap_by_half_in_training_as_in_scoring(spark):
    text = " ".join(f"w{i}" for i in range(37))
    rows = spark.createDataFrame([(1, 0, text), (2, 1, None)], "doc long, toxic int, text string")
    got = [r["words"].split() for r in toxicity._windows(rows).where("doc = 1").collect()]
    assert got == [[f"w{i}" for i in range(s, min(s + 16, 37))] for s in range(0, 37, 8)]
    assert toxicity._windows(rows).where("doc = 2").collect()[0]["words"] == ""
    weights = np.arange(37.0) % 11
    best = max(sum(weights[s:s + 16]) for s in range(0, 37, 8)) / 16
    assert np.isclose(toxicity.top_window(np.arange(37), np.stack([weights, np.ones(37)], axis=1), 0.5), best + 0.5)


def test_score_equals_the_mean_vector_through_the_softmax():
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gam9ma", "--", "ALPHA"]
    grams, of = toxicity._word_grams(["alpha", "beta", "gam9ma"])
    keys = np.unique(grams)
    model = toxicity.Model(keys, rng.standard_normal(len(keys)), -0.3)
    weight = dict(zip(keys.tolist(), model.weights))
    mean = [np.mean([weight[g] for g in grams[of == i].tolist()]) for i in range(3)]
    text = " ".join(words)
    cache = TokenCache(lambda t: toxicity.word_logits(model, t))
    got = toxicity.scores(model, [text], cache)[0]
    assert np.isclose(got, 1 / (1 + np.exp(-(sum(mean) / toxicity.LEAST - 0.3))))


def test_held_out_accuracy_on_given_tables(spark):
    from goldmart.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op1_toxicity"](spark, sf)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    seen = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in seen}
    assert n.get((1, 1), 0) >= 0.7 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * (n[(0, 0)] + n.get((0, 1), 0))
