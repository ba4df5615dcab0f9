import hashlib
import random
import re
import time

import xxhash
from pyspark.sql import functions as F

from goldmart.llm import fingerprints


def hashed(*parts):
    """Spark's xxhash64 of texts: each is hashed with the hash so far as its seed."""
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed)
    return seed


def plain_paragraphs(text):
    """Distinct paragraphs by rule, as tuples of units."""
    u = [x for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w for x in ([w] if len(w) <= fingerprints.RUN else w)]
    if len(u) < fingerprints.LEAST:
        return {(a, b) for a, b in zip("\x02" + text, text)} | {(w,) for w in u}
    size, out = 1 << ((len(u) // fingerprints.LEAST).bit_length() - 1), set()
    for n in (size, 2 * size):
        starts, before = [], 0
        for end in (i + 1 for i in range(len(u)) if i == len(u) - 1 or hashed(*u[i:i + fingerprints.AHEAD]) % n == 0):
            starts += range(before, end, fingerprints.STRETCH * n)
            before = end
        out |= {tuple(u[s:e]) for s, e in zip(starts, starts[1:] + [len(u)])}
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_likeness(a, b):
    a, b = plain_paragraphs(a), plain_paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    docs = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(hashed(r[1] or "")), r[1] or ""))
    out = []
    for k, (i, text) in enumerate(docs):
        text, nxt = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(plain_likeness(text, edited), 9), round(plain_likeness(text, nxt), 9)))
    return sorted(out, key=repr)


def check(spark, rows, **extra):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = fingerprints.compare_versions(df.withColumns(extra) if extra else df)
    got = got.withColumn("sha", F.sha2("edited", 256)).collect()
    assert sorted(((r["id"], r["n_chars"], r["sha"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got), key=repr) == expected(rows)
    return got


def test_odd_rows(spark):
    rng = random.Random(2)
    long = "\n".join("".join(rng.choices("abcdé \U0001F600", k=rng.randint(1, 700))) for _ in range(400))
    rows = [(1, None), (2, ""), (3, "a"), (4, "short text"), (5, long), (6, long), (7, long[:50_000] + "changed" + long[50_000:]),
            (8, "x" * 30_000), (9, "\n\n\n"), (10, "line\n" * 5000), (11, "é\U0001F600" * 100), (-5, "negative id"), (10**15, "far away"),
            (4, "another with equal id"), (4, "short text"), (None, "no id"), (None, None)]
    got = check(spark, rows, edited=F.lit("clash"), Bucket=F.lit(1), near_next=F.lit(0.5), ID=F.lit(3))
    same = {}
    for r in got:
        if r["id"] in (5, 6):
            same.setdefault(r["fingerprint"], []).append(r["id"])
    assert sorted(map(len, same.values())) == [2]


def test_single_and_empty(spark):
    rows = check(spark, [(1, "only one text, its own successor")])
    assert rows[0]["near_next"] == 1.0
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints.compare_versions(df).count() == 0


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_A_BUCKET", 3)
    check(spark, [(i * i, f"text of {i} " * (i % 7)) for i in range(80)] + [(9, "equal id"), (None, "x")])


def test_peeling_recovers_the_differing_digests_and_retries(spark):
    rng = random.Random(1)
    rows = []
    for n in [0, 1, 3, 8, 12, 25, 60]:
        for _ in range(12):
            pool = [rng.getrandbits(63) for _ in range(2 * n)]
            rows.append((pool[:n] + pool[n:n + n // 2], pool[:n]))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    df = df.select(*[F.array_sort(F.transform(c, fingerprints.checked)).alias(c) for c in "ab"])
    wide = lambda c: fingerprints.sketch(F.col(c), F.lit(64))
    got = df.select("a", "b", fingerprints.peel(fingerprints.subtract(wide("a"), wide("b")), F.lit(64)).alias("found"),
                    fingerprints.part_difference(F.col("a"), F.col("b")).alias("n"), fingerprints.difference(F.col("a"), F.col("b")).alias("d")).collect()
    for r in got:
        assert r["n"] == r["d"] == len(set(r["a"]) ^ set(r["b"]))
        if r["found"] is not None:
            assert {(f["n"], f["key"]) for f in r["found"]} == {(1, k) for k in set(r["a"]) - set(r["b"])}
    assert sum(r["found"] is not None for r in got) > 0.95 * len(got)


def test_digests_that_share_all_cells_take_the_larger_sketches(spark):
    same = [(i << 40) | 0x123456 for i in range(1, 9)]  # no check holds and every attempt's first places are equal
    df = spark.createDataFrame([(same, [])], "a array<long>, b array<long>")
    assert df.select(fingerprints.part_difference(F.col("a"), F.col("b")).alias("n")).first()["n"] == len(same)


def test_paragraphs_stay_bounded_and_linear(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(160_000)]
    texts = [" ".join(words), " ".join(words[:80_000] + words[1000:81_000]), "la " * 100_000, "x" * 160_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = time.time()
    rows = {r["id"]: r for r in fingerprints.compare_versions(df).collect()}
    assert time.time() - start < 60
    assert all(len(plain_paragraphs(t)) < 200 for t in texts)
    assert rows[1]["near_next"] == plain_likeness(texts[1], texts[0]) > 0.1


def test_registered_query(spark):
    from goldmart.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_document_fingerprints"](spark, sf).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got), key=repr) == expected(docs)
    text = dict(docs)
    by_print = {}
    for r in got:
        by_print.setdefault(r["fingerprint"], set()).add(text[r["doc_id"]])
    assert all(len({tuple(sorted(plain_paragraphs(t or ""))) for t in v}) == 1 for v in by_print.values())


def test_paragraphs_stand_an_insertion_and_short_texts(spark):
    rng = random.Random(9)
    plain = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(1200))
    run = "".join(rng.choices("abcdefgh", k=4000))
    pairs = [(plain, plain[:5] + "X" + plain[5:]), (run, run[:5] + "X" + run[5:]), (plain, plain), ("", "")]
    for a, b in pairs:
        got = fingerprints.compare_versions(spark.createDataFrame([(2, a), (1, b)], "doc_id long, text string")).where("id = 2").first()
        assert got["near_next"] > 0.9
    short = [(n, "".join(rng.choices("klmnopqrstuvw", k=n))) for n in range(2, 31)]
    found = fingerprints.compare_versions(spark.createDataFrame([(n, t) for n, t in short] + [(1, "0123456789 !?%&()[]+*#-=;:,.<>")], "doc_id long, text string")).where("id > 1").collect()
    assert all(r["near_edited"] > 0 for r in found) and all(r["near_next"] < r["near_edited"] for r in found if r["n_chars"] > 12)
