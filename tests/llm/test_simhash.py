import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from goldmart.llm import simhash


def plain_fingerprint(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items, linked):
    root = {i: i for i, _ in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(items, 2):
        if linked(a, b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i: find(i) for i, _ in items}


TEXTS = [None, "", " \t\n", "One", "one", "one two", "ONE two three", "one two three", "É é", "a b c d e " * 2000, "a b c d e " * 2000, "x\x0by\x0cz w"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_plain(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_masks_cover_every_pair():
    masks = simhash.covering_masks(2)
    assert all(any(not (m >> a & 1 or m >> b & 1) for m in masks) for a, b in itertools.combinations(range(64), 2))
    four = simhash.covering_masks(4)
    rng = random.Random(1)
    for _ in range(3000):
        bits = rng.sample(range(64), 4)
        assert any(not any(m >> b & 1 for b in bits) for m in four)


def test_links_join_exactly_what_lies_within_two_bits(spark):
    rng = random.Random(5)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):  # chains and crowds of near values
            values.add(at)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                at ^= 1 << b
    crowd = rng.getrandbits(64)
    values |= {crowd ^ 1 << a ^ 1 << b for a, b in itertools.combinations(range(20), 2)}
    signed = {simhash._signed(v): v for v in values}
    prints = spark.createDataFrame([(i, fp) for i, fp in enumerate(sorted(signed))], "id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.fingerprint_components(prints).collect()}
    ids = {fp: i for i, fp in enumerate(sorted(signed))}
    expected = plain_components([(ids[fp], signed[fp]) for fp in signed], lambda a, b: (a ^ b).bit_count() <= 2)
    assert {ids[fp]: c for fp, c in got.items()} == expected


def test_odd_rows_and_keep_one(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "One"), (None, "one two"), (None, None), (99, "entirely different words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"FP": F.lit(1), "Component_ID": F.lit(2), "id": F.lit("clash"), "root": F.lit(0)})
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    zero = [r["component_id"] for r in found if r["fp"] == 0]
    assert len(zero) == 4 and set(zero) == {0}
    kept = simhash.keep_one(df).collect()
    assert kept[0].asDict().keys() == set(df.columns)
    components = {r["component_id"] for r in found}
    assert sorted(r["doc_id"] for r in kept) == sorted(components)
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_registered_query_against_all_pairs(spark):
    from goldmart.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs]
    expected = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    rows = QUERIES["op9_simhash_near_dedup"](spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{fp:016x}", expected[i]) for i, fp in prints}
