import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldmart.llm import mixing

TARGETS = {"news": 0.6, "code": 0.3, "spam": 0.1}
WORDS = {"news": ["minister", "vote", "city", "said"], "code": ["def", "return", "class", "import"], "spam": ["buy", "cheap", "now", "win"]}


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        d = rng.choices(list(WORDS), weights=[2, 5, 3])[0]
        words = [rng.choice(WORDS[d if rng.random() < 0.8 else rng.choice(list(WORDS))]) for _ in range(rng.choice([3, 40, 300]))]
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            labels.append((i, d))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "id long, domain string")


def test_expected_totals_match_targets_and_rates_are_the_projected_gradient(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows + [(1000, None), (1001, " "), (5, rows[5][1])], labels + [(None, "news"), (1, None), (2, "other")])
    found = mixing.rates(docs, known, TARGETS).collect()
    m = np.array([r["copies"] * r["tokens"] for r in found], float)
    p = np.array([[r["p0"], r["p1"], r["p2"]] for r in found])
    rate = np.array([r["rate"] for r in found])
    share = np.array(list(TARGETS.values()))
    assert (rate >= 0).all() and np.allclose(p.sum(axis=1), 1)
    assert np.abs(p.T @ (m * rate) / m.sum() - share).max() < 1e-3
    gram = (p * m[:, None]).T @ p
    r = np.ones(len(m))  # brute force: the same iteration over an explicit rate vector
    for _ in range(mixing.MAX_STEPS):
        residual = p.T @ (m * r) - share * m.sum()
        if np.abs(residual).max() <= mixing.TOLERANCE * m.sum():
            break
        r = np.clip(r - p @ np.linalg.solve(gram, residual), 0, mixing.MAX_RATE)
    assert np.allclose(rate, r, atol=1e-6)
    tokens = {r["id"]: (r["tokens"], r["copies"]) for r in found}
    assert tokens[1000] == (0, 1) and tokens[1001] == (0, 1) and tokens[5] == (len(rows[5][1].split()), 2)


def test_a_target_that_no_document_can_serve(spark):
    rows, labels = corpus(60)
    docs, known = frames(spark, rows, [(i, "news") for i, _ in labels])
    found = mixing.rates(docs.where("doc_id = 0"), known, {"news": 0.1, "spam": 0.9}).collect()
    assert len(found) == 1 and 0 <= found[0]["rate"] <= mixing.MAX_RATE


def test_posteriors_equal_plain_naive_bayes(spark):
    import xxhash

    rows, labels = corpus(120)
    docs, known = frames(spark, rows, labels)
    domains = list(TARGETS)
    got = {r["id"]: [r["p0"], r["p1"], r["p2"]] for r in mixing.posteriors(docs, mixing.classifier(docs, known, domains, "doc_id", "text"), domains).collect()}
    hashed = {r["w"]: (r["f0"], r["f1"]) for r in spark.createDataFrame([(w,) for ws in WORDS.values() for w in ws], "w string").select(
        "w", *[f.alias(f"f{k}") for k, f in enumerate(mixing._features(F.col("w")))]).collect()}
    assert all(hashed[w][0] == xxhash.xxh64_intdigest(w.encode(), 42) % mixing.BUCKETS for w in hashed if xxhash.xxh64_intdigest(w.encode(), 42) < 1 << 63)
    text, counts = dict(rows), {d: Counter() for d in domains}
    for i, d in labels:
        for w in text[i].split():
            counts[d].update(hashed[w])
    prior = Counter(d for _, d in labels)
    for i, t in rows:
        words = t.split()
        logit = []
        for d in domains:
            total = sum(counts[d].values()) / 2
            ll = sum(np.log((counts[d][f] + mixing.SMOOTHING) / (total + mixing.SMOOTHING * mixing.BUCKETS)) for w in words for f in hashed[w])
            logit.append(np.log((prior[d] + 1) / (len(labels) + 3)) + ll * min(len(words), mixing.EVIDENCE) / max(len(words), 1))
        want = np.exp(np.array(logit) - max(logit))
        assert np.allclose(got[i], want / want.sum(), atol=1e-9)


def test_mix_repeats_and_drops_rows(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(400)] + [(None, None), (7, "t7")], "doc_id long, text string").withColumns({"Rate": F.lit("x"), "ID": F.lit(1)})
    rate = F.when(F.col("id") < 100, 0.0).when(F.col("id") < 200, 2.0).otherwise(1.5)
    found = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key")).distinct().withColumn("rate", rate)
    got = mixing.mix(docs, found)
    assert got.columns == docs.columns
    n = Counter(r["doc_id"] for r in got.collect())
    assert not any(n[i] for i in range(100)) and all(n[i] == 2 for i in range(100, 200)) and {n[i] for i in range(200, 400)} == {1, 2}
    assert n[None] in (1, 2) and abs(sum(n[i] for i in range(200, 400)) / 200 - 1.5) < 0.15


@pytest.mark.parametrize("empty", ["docs", "labels"])
def test_empty_tables(spark, empty):
    rows, labels = corpus(30)
    docs, known = frames(spark, rows, labels)
    found = mixing.rates(docs.limit(0) if empty == "docs" else docs, known.limit(0) if empty == "labels" else known, TARGETS)
    assert found.count() == (0 if empty == "docs" else 30)
    if empty == "labels":
        assert all(abs(r["p0"] - 1 / 3) < 1e-9 for r in found.collect())


def skewed(spark, share, n=300, sharp=0.999):
    """One document of the first domain with ``share`` of the tokens, the rest of the second."""
    m = [round(share * 100_000)] + [100_000 // n] * n
    p = [sharp] + [1 - sharp * (0.9 + 0.1 * i / n) if i % 2 else 1 - sharp for i in range(n)]
    return spark.createDataFrame([(i, 1, x, q, 1 - q) for i, (x, q) in enumerate(zip(m, p))], "id long, copies long, tokens long, p0 double, p1 double")


@pytest.mark.parametrize("share", [0.05, 0.005, 0.0005])
def test_a_rare_domain_meets_its_target(spark, share):
    members = skewed(spark, share, sharp=1.0)
    found, left = mixing.fit_rates(members, [0.9, 0.1])
    assert left <= mixing.TOLERANCE
    rows = found.collect()
    total = sum(r["tokens"] for r in rows)
    assert abs(sum(r["tokens"] * r["rate"] * r["p0"] for r in rows) / total - 0.9) <= 2 * mixing.TOLERANCE
    assert all(r["rate"] >= 0 for r in rows) and max(r["rate"] for r in rows) > 16


def test_the_residual_is_told_and_rates_are_bounded_on_request(spark):
    members = skewed(spark, 0.005)
    with pytest.warns(UserWarning, match="off its target"):
        found, left = mixing.fit_rates(members, [0.9, 0.1], max_rate=4.0)
    assert left > 0.1 and max(r["rate"] for r in found.collect()) <= 4.0
    only = members.where("id > 0").withColumns({"p0": F.lit(0.0), "p1": F.lit(1.0)})
    with pytest.warns(UserWarning, match="off its target"):
        assert mixing.fit_rates(only, [0.9, 0.1])[1] > 0.8


def test_large_rates_are_copied_in_chunks(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id long, text string")
    found = spark.createDataFrame([(1, 25_000.0), (2, 0.0), (3, 10_000.0)], "id long, rate double")
    keyed = found.join(docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key")), "id")
    counts = {r["doc_id"]: r["count"] for r in mixing.mix(docs, keyed).groupBy("doc_id").count().collect()}
    assert counts == {1: 25_000, 3: 10_000}
