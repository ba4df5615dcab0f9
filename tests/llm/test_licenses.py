import random
import re

from pyspark.sql import functions as F

from goldmart.llm import licenses


def words_of(text):
    return re.sub(r"[^\w\n]+|_", " ", (text or "").lower()).split()


def grams_of(words):
    return set(zip(words, words[1:]))


def plain(text, templates, threshold):
    """Matches of every unit against every template, without pruning."""
    norm = re.sub(r"(?:[^\w\n]|_)+", " ", (text or "").lower())
    units = [("text", 0, norm)]
    units += [("block", i, b) for i, b in enumerate(re.split(r"\n *\n[ \n]*", norm))]
    units += [("line", i, x) for i, x in enumerate(norm.split("\n"))]
    out = []
    for kind, i, unit in units:
        a, best = grams_of(unit.split()), None
        for name, body in templates:
            b = grams_of(words_of(body))
            dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0.0
            if dice >= threshold and (best is None or (-dice, name) < best):
                best = (-dice, name)
        if best:
            out.append((kind, i, best[1], round(-best[0], 9)))
    return out


def texts():
    rng = random.Random(4)
    full = dict((name, body) for name, body in licenses.TEMPLATES)
    noise = lambda n: " ".join("".join(rng.choices("abcde", k=4)) for _ in range(n))
    out = [None, "", "x", "All rights reserved.", "ALL  RIGHTS--reserved", "all rights", noise(500), "the " * 5000, noise(100_000)]
    for _, body in licenses.TEMPLATES:
        words = body.split()
        out.append(noise(40) + "\n" + body + "\n" + noise(30))
        out.append(noise(20) + "\n\n" + "\n".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9)) + "\n\n" + noise(25))
        for drop in (1, 5, 20):
            out.append(" ".join(w for w in words if rng.randrange(100) >= drop) + " " + noise(drop))
    out.append(full["MIT"] + "\n" + full["Apache-2.0"])
    return out


def test_equals_all_units_against_all_templates(spark):
    rows = list(enumerate(texts())) + [(0, None), (3, "All rights reserved.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"Matches": F.lit(1), "license": F.lit("x"), "dice": F.lit(0)})
    for threshold in (0.8, 0.5, 1.0):
        got = licenses.scan(df, threshold=threshold)
        assert got.columns == ["doc_id", "text", "license", "dice", "matches"]
        for r in got.collect():
            assert [(m["kind"], m["unit"], m["license"], round(m["dice"], 9)) for m in r["matches"]] == plain(r["text"], licenses.TEMPLATES, threshold)
    assert licenses.scan(df.limit(0)).count() == 0


def test_own_templates(spark):
    df = spark.createDataFrame([("one two three four",), ("one two three five",)], "text string")
    got = licenses.scan(df, [("b", "one two three four"), ("a", "one two three four")]).orderBy("text").collect()
    assert [{m["license"] for m in r["matches"]} for r in got] == [set(), {"a"}]


def best_stretch(text, body):
    """Greatest Dice of any stretch of words against one template, tried one by one."""
    words, b = words_of(text), grams_of(words_of(body))
    most = int(1.5 * (len(words_of(body)) - 1))
    best = 0.0
    for i in range(len(words) - 1):
        for j in range(i + 2, min(len(words), i + most + 1) + 1):
            a = grams_of(words[i:j])
            best = max(best, 2 * len(a & b) / (len(a) + len(b)))
    return best


def test_licences_that_fill_no_unit_are_found_as_passages(spark):
    full = dict((name, body) for name, body in licenses.TEMPLATES)
    rng = random.Random(7)
    noise = lambda n: " ".join("".join(rng.choices("abcde", k=4)) for _ in range(n))
    paragraphs = full["MIT"].replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
    bsd = full["BSD-2-Clause"].replace("1. ", "\n\n 1. ").replace("2. ", "\n\n 2. ").replace("THIS SOFTWARE IS", "\n\nTHIS SOFTWARE IS")
    rows = [
        ("Copyright 2024 Acme Inc. All rights reserved.", {"Proprietary"}),
        ("This library is released under the MIT License, see the file LICENSE.", {"MIT"}),
        (f"{noise(60)}\n\nCopyright (c) 2024 A. Person\n\n{paragraphs}\n\n{noise(300)}", {"MIT"}),
        (f"{noise(60)}\n\n{bsd}\n\n{noise(300)}", {"BSD-2-Clause"}),
        ("Data: This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. Code: licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
        ("all rights of the reserved under the license " * 40, set()),
        (None, set()), ("", set()), ("word", set()),
        (f"see {noise(9)} All rights reserved. {noise(9)} " * 50, {"Proprietary"}),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["matches"] for r in licenses.scan(df, passages=True).collect()}
    for i, (text, want) in enumerate(rows):
        found = [m for m in got[i] if m["kind"] == "passage"]
        assert {m["license"] for m in found} == want, (i, found)
    assert sum(m["kind"] == "passage" for m in got[9]) == 50
    assert max(m["dice"] for m in got[0]) == 1.0 and max(m["dice"] for m in got[2]) > 0.99


def test_a_passage_is_found_wherever_some_stretch_reaches_the_threshold(spark):
    rng = random.Random(11)
    body = "one two three four five six seven two three eight"
    texts = [" ".join(rng.choice(body.split() + ["x"] * k) if rng.random() < 0.2 else w for w in ["x"] * 6 + body.split() + ["x"] * 6) for k in range(12) for _ in range(8)]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [("L", body)], passages=True).collect()
    hits = 0
    for r in got:
        found = [m["dice"] for m in r["matches"] if m["kind"] == "passage"]
        best = best_stretch(r["text"], body)
        assert bool(found) == (best >= 0.8) and all(0.8 <= d <= best + 1e-12 for d in found)
        hits += bool(found)
    assert 10 < hits < len(texts) - 10


def test_passages_leave_the_units_as_they_are(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    for threshold in (0.8, 0.5):
        units, both = ({r["doc_id"]: r["matches"] for r in licenses.scan(df, threshold=threshold, passages=p).collect()} for p in (False, True))
        assert {i: [m for m in found if m["kind"] != "passage"] for i, found in both.items()} == units
        assert all({m["license"] for m in units[i]} <= {m["license"] for m in both[i]} for i in units)
