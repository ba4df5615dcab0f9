import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from goldmart.llm import langid

A = ["the", "thing", "that", "there", "bath", "with", "than"]
B = ["der", "das", "schön", "ich", "nicht", "über", "doch"]


def plain_kneser_ney(counts, order, alphabet):
    """p(c | history) of interpolated Kneser-Ney with plain dictionaries; words with begin and end marks."""
    grams = {n: Counter() for n in range(1, order + 1)}
    for word, c in counts.items():
        s = "\x02" + word + "\x03"
        for i in range(1, len(s)):
            for n in range(1, order + 1):
                if i - n + 1 >= 0:
                    grams[n][s[i - n + 1:i + 1]] += c
    used = {order: grams[order]}
    for n in range(1, order):
        used[n] = Counter({g: c for g, c in grams[n].items() if g[0] == "\x02" and n > 1})
        for g in grams[n + 1]:
            if not (n == 1 and g[1:] == "\x02"):
                used[n][g[1:]] += 1

    def p(c, history):
        n = len(history) + 1
        below = p(c, history[1:]) if history else 1 / alphabet
        level = used[n]
        total = sum(v for g, v in level.items() if g[:-1] == history)
        if not total:
            return below
        ones, twos = sum(v == 1 for v in level.values()), sum(v == 2 for v in level.values())
        d = ones / max(ones + 2 * twos, 1) if ones else 0.5
        kinds = sum(g[:-1] == history for g in level)
        return max(level.get(history + c, 0) - d, 0) / total + max(d * kinds / total, 1e-9) * below

    return p


def test_scores_equal_plain_kneser_ney(spark):
    a, b = Counter({w: i + 1 for i, w in enumerate(A)}), Counter({w: i + 1 for i, w in enumerate(B)})
    words = spark.createDataFrame([("ab"[k], w, n) for k, own in enumerate((a, b)) for w, n in own.items()], "lang string, word string, n long")
    rows = langid.gram_counts(words, 4).collect()

    def counts(n):
        own = [r for r in rows if r["size"] == n]
        return [r["gram"] for r in own], np.array(["ab".index(r["lang"]) for r in own]), np.array([r["n"] for r in own])

    alphabet = len(set("".join([*a, *b])) | {"\x02", "\x03"}) + 1
    model = langid.fit(counts, ["a", "b"], alphabet, order=4)
    tokens = ["the", "thant", "schöner", "xyz", "t", "The9!th", "12"]
    scores = langid.word_scores(model, tokens)
    for k, own in enumerate((a, b)):
        p = plain_kneser_ney(own, 4, alphabet)
        for t, got in zip(tokens, scores):
            word = "".join(c for c in t if c.isalpha())
            s = "\x02" + word + "\x03"
            want = sum(math.log(p(s[i], s[max(0, i - 3):i])) for i in range(1, len(s))) if word else 0
            assert math.isclose(got[k], want, rel_tol=1e-4, abs_tol=1e-4), (t, k)
            assert got[-1] == (len(word) + 1 if word else 0)


def test_letters_alike_in_learning_and_prediction(spark):
    texts = ["नमस्ते दुनिया 12", "cafe\u0301 1\u0301a \u0301x", "½ ² Ⅷ ③ 7", "a\u00a0b Ünï-cödé"]
    found = langid.word_counts(spark.createDataFrame([("x", t) for t in texts], "lang string, text string")).collect()
    assert {r["word"] for r in found} == {"नमस्ते", "दुनिया", "cafe\u0301", "a", "x", "b", "ünïcödé"}
    train = [(i, t, l) for i in range(20) for t, l in ((f"{texts[0]} नमस्ते", "hi"), ("the that thing there", "en"))]
    model = langid.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"), F.lit(True))
    rows = langid.predict(spark.createDataFrame([(t,) for t in ("½ ²", "Ⅷ ③", "\u0301 \u0301", "नमस्ते", "that")], "text string"), model).collect()
    assert [r["lang_pred"] for r in rows] == ["und", "und", "und", "hi", "en"]
    assert [r["score"] == 0 for r in rows] == [True, True, True, False, False]


def test_one_id_on_most_rows_leaves_the_sample_whole(spark):
    train = [(i, " ".join(np.random.default_rng(i).choice(A if i % 2 else B, 40)), "a" if i % 2 else "b") for i in range(400)]
    hot = spark.range(20_000).selectExpr("1L AS doc_id", "concat('the that ', id) AS text", "'a' AS lang")
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    with_hot = langid.learn(docs.unionByName(hot), F.lit(True), per_language=150)
    without = langid.learn(docs, F.lit(True), per_language=150)
    assert [len(g) for g in with_hot.grams[:2]] == [len(g) for g in without.grams[:2]]
    assert np.allclose(with_hot.limits, without.limits, rtol=0.1)


def test_ties_go_to_the_first_language(spark):
    train = [(i, "the that thing", l) for i, l in enumerate(["b", "a"] * 20)]
    model = langid.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"), F.lit(True))
    assert [r["lang_pred"] for r in langid.predict(spark.createDataFrame([("that",), ("zz",)], "text string"), model).collect()] == ["a", "a"]


def test_odd_rows(spark):
    train = [(i, " ".join(np.random.default_rng(i).choice(A if i % 2 else B, 40)), "a" if i % 2 else "b") for i in range(60)]
    train += [(100, "zzz", None), (101, None, "a"), (None, "the that", "a"), (1, train[1][1], "a")]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = langid.learn(docs, F.lit(True))
    assert model.langs == ["a", "b"]
    odd = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the that thing"), (5, "ich doch nicht"), (6, "the that " * 60_000), (6, "the that " * 60_000), (7, "qqqq wwww xxxx qqqq")]
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumns({"LANG_PRED": F.lit("x"), "lang": F.lit("b")})
    rows = langid.predict(df, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows][:7] == ["und", "und", "und", "a", "b", "a", "a"]
    assert [r["rejected"] for r in rows] == [True, True, True, False, False, False, False, True]
    assert all(0 <= r["score"] <= 1 for r in rows) and rows[0]["score"] == 0
    assert langid.predict(df.limit(0), model).count() == 0
    nothing = langid.learn(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(df, nothing).collect()} == {"und"}


def test_held_out_accuracy_on_given_tables(spark):
    from goldmart.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_language_id"](spark, sf)
    assert rows.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    seen = rows.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert seen.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.99
    assert rows.where("rejected").count() <= 0.01 * rows.count()


def test_mislabelled_documents_do_not_lift_the_limit(spark):
    other = ["кот", "дом", "река", "небо", "зима"]
    draw = lambda i, words: " ".join(np.random.default_rng(i).choice(words, 40))
    train = [(i, draw(i, A if i % 2 else B), "a" if i % 2 else "b") for i in range(800)]
    train += [(1000 + i, draw(1000 + i, B), "a") for i in range(8)] + [(2000 + i, draw(2000 + i, A), "b") for i in range(8)]
    train += [(3000, "kurz", "c")]
    model = langid.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"), F.lit(True))
    assert np.isfinite(model.limits).all()
    clean = langid.learn(spark.createDataFrame(train[:800], "doc_id long, text string, lang string"), F.lit(True))
    assert np.allclose(model.limits[:2], clean.limits, rtol=0.3)
    rows = spark.createDataFrame([(draw(5000 + i, w),) for i in range(40) for w in (A, B, other)], "text string")
    got = langid.predict(rows, model).collect()
    assert all(r["rejected"] == (r["text"].split()[0] in other) for r in got)
