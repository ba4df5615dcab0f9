import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from goldmart.llm import divergence


def plain(rows, least, top=50):
    """The rows by rule: (lang, source, part, item, value, rank)."""
    docs = [((lang or ""), (source or ""), [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    seen, groups, counts = defaultdict(Counter), defaultdict(set), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        groups[lang].add(source)
    kept = {lang: {t for t, n in own.items() if n >= least} for lang, own in seen.items()}
    for lang, source, terms in docs:
        counts[lang, source].update(t for t in terms if t in kept[lang])
    out = []
    for lang, sources in groups.items():
        terms, whole = kept[lang], sum((counts[lang, s] for s in sources), Counter())

        def share(c):
            below = sum(c.values()) + 5 * len(terms)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // below for t in terms}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(other, sum(abs(p[s][t] - p[other][t]) for t in terms)) for other in sources if other != s]
            over = [(t, p[s][t] - q[t]) for t in terms if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def audited(spark, rows, least, **kw):
    df = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, Term int")
    return sorted(map(tuple, divergence.audit(df.repartition(4), least_docs=least, **kw).collect()))


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "abcdefghijkl", "abcdefghijklm", "x" * 36, "x" * 37, "y" * 200, "é", "éé", "ñandú", "日本語の", "日本", "Zürich", "ABC", "zz"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", "-", "9", "\n", "_", ""]) for _ in range(rng.randint(0, 12)))
        rows.append((rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "", None]), text if rng.random() > 0.05 else None))
    return rows


@pytest.mark.parametrize("seed, least", [(1, 5), (2, 1), (3, 25), (4, 1000)])
def test_rows_equal_the_plain_rule(spark, seed, least):
    rows = random_rows(seed)
    assert audited(spark, rows, least) == plain(rows, least)


@pytest.mark.parametrize("first, bits", [(1, 24), (2, 6), (4, 10), (50, 8)])
def test_levels_and_shared_bits_do_not_change_the_result(spark, first, bits):
    rows = random_rows(7)
    assert audited(spark, rows, 6, first=first, bits=bits) == plain(rows, 6)


def test_counts_handed_out_early_do_not_change_the_result(spark, monkeypatch):
    rows = random_rows(8) * 3
    for name, value in (("_TERMS", 2), ("_ENTRIES", 3), ("_BATCH", 2), ("_SLICE", 100)):
        monkeypatch.setattr(divergence, name, value)
    tally = divergence._Tally(lambda t: t)
    tally.add([(b"en",)] * 2, [b"a b a", b"a"], True)
    found = [r for batch in tally.handed_out(lambda o, k: True, ["lang", "key", "n"]) for r in batch.to_pylist()]
    assert {(r["key"], r["n"]) for r in found} == {(b"a", 2), (b"b", 1)}
    assert audited(spark, rows, 20) == plain(rows, 20)


def test_terms_of_one_language_do_not_keep_those_of_another(spark):
    rows = [("en", "s", "shared only")] * 5 + [("de", "s", "shared")] * 2
    kept = divergence.kept_terms(spark.createDataFrame(rows, "lang string, source string, text string"), least_docs=3)
    assert sorted((r["lang"], bytes(r["key"])) for r in kept.collect()) == [("en", b"only"), ("en", b"shared")]


def test_repeated_rows_hot_source_and_empty_table(spark):
    rows = [("en", "hot", "same words here")] * 300 + [("en", f"s{i}", "same other") for i in range(20)] + [("en", "hot", "w " * 50_000)]
    assert audited(spark, rows, 10) == plain(rows, 10)
    assert audited(spark, [], 10) == []


def test_share_is_exact_for_large_counts(spark):
    big = 4_000_000_000_000_003
    row = spark.range(1).select(divergence.share(F.lit(big), F.lit(3 * big), F.lit(12_345_678)).alias("p"), divergence.share(F.lit(0), F.lit(0), F.lit(0)).alias("z")).first()
    assert row["p"] == 1 + 1_000_000_000 * (big + 5) // (3 * big + 5 * 12_345_678) and row["z"] == 1


def test_terms_of_many_texts_are_cut_at_once():
    texts = [b"x", b"ab", "", "Zürich-a\x00B\n", b"", b" c ", b"d\xc2\x85e\x85", b"9"]
    texts = [t.encode() if isinstance(t, str) else t for t in texts]
    for cut in (slice(None), slice(1, 6), slice(2, 3), slice(0, 0)):
        part = pa.array(texts, pa.binary())[cut]
        terms, row = divergence.terms_of(part)
        expected = [(i, t) for i, text in enumerate(texts[cut]) for t in text.translate(divergence._SPLIT).split()]
        assert list(zip(row.tolist(), terms.to_pylist())) == expected


def test_only_distinct_terms_of_a_slice_are_numbered_one_by_one():
    class Counted(divergence.TokenIds):
        asked = 0

        def __getitem__(self, term):
            Counted.asked += 1
            return super().__getitem__(term)

    tally = divergence._Tally(lambda t: t)
    tally.terms = Counted()
    tally.add([(b"en",)] * 2, [b"a b " * 500, b"a"], True)
    assert Counted.asked == 2 and [int(n) for n in tally.ns[0]] == [2, 1]


def test_checksums_of_many_values_at_once():
    rng = random.Random(3)
    values = [rng.randbytes(rng.choice([0, 1, 6, 36, 63, 64, 65, 700])) for _ in range(300)]
    for cut in (slice(None), slice(7, 12), slice(0, 0)):
        part = pa.array(values, pa.binary())[cut]
        for before in (0, zlib.crc32(b"en\x00")):
            assert divergence.crc32s(part, before).tolist() == [zlib.crc32(v, before) for v in values[cut]]


def test_only_distinct_keys_of_a_slice_become_python_objects():
    tally = divergence._Tally(lambda terms: divergence._only(pc.binary_slice(terms, 0, 1), pc.greater(pc.binary_length(terms), 1)))
    tally.add([(b"en",), (b"de",)], [b"ab ac ad b bb ab", b"b ax"], False)
    assert list(tally.terms) == [b"a", b"b"]
    found = [r for batch in tally.handed_out(lambda lang, keys: lang == b"en", ["lang", "key", "n"]) for r in batch.to_pylist()]
    assert [(r["lang"], r["key"], r["n"]) for r in found] == [(b"en", b"a", 4), (b"en", b"b", 1)]
