import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from goldmart.llm import infill
from goldmart.llm.queries import QUERIES
from tests.llm.conftest import SF_SMALL

P, S, M = "<P>", "<S>", "<M>"


def plain(key, text):
    """The row by rule: (n, form, prefix characters, middle characters, output)."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in (P, S, M)) or h[2] % 100 >= 100:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = S + suffix + P + prefix + M + middle if form == "spm" else P + prefix + S + suffix + M + middle
    return len(units), form, len(prefix), len(middle), out


TEXTS = [
    None, "", "\n", "a", "a\n", "\n\n\n", "one\ntwo\nthree", "é\n\U0001F600x\n\n ü", "a<P>b\nc", "<S", "<\n<\n<P\n<", "<M><S>", "x\r\ny\r\n",
    "line\n" * 30_000, "no end " * 40_000, "é\n" * 50_001 + "tail",
]


def test_rows_equal_the_plain_rule_and_restore(spark):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab\n<PSM>é") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["same\ntext"] * 3
    rows = [(None if i % 50 == 7 else i // 2, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, FORM string").repartition(5)
    made = infill.transform(df, restore_too=True)
    assert [f.lower() for f in made.columns].count("form") == 1  # the clashing column is replaced
    got = made.collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], bytes(r["output"]).decode()) == want
        assert bytes(r["restored"]).decode() == (r["text"] or "")
    again = infill.restore(made.drop("restored")).where(F.col("restored") != F.coalesce("text", F.lit("")).cast("binary"))
    assert again.count() == 0


def test_empty_table_and_null_outputs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert infill.transform(empty).count() == 0
    odd = spark.createDataFrame([(None, "psm"), (bytearray(b"x"), None)], "output binary, form string")
    assert [r["restored"] for r in infill.restore(odd).collect()] == [None, None]


@pytest.mark.parametrize("share, spm, forms", [(0, 50, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"}), (50, 50, {"plain", "psm", "spm"})])
def test_shares_of_the_forms(spark, share, spm, forms):
    df = spark.range(200).selectExpr("id AS doc_id", "'a\\nb\\nc' AS text")
    made = infill.transform(df, draw=infill.Draw("s", share, spm), restore_too=True)
    assert {r["form"] for r in made.select("form").distinct().collect()} == forms
    assert made.where("restored <> cast(text AS binary)").count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 10, 131_072, 200_001])
def test_rotation_exchanges_segments(size):
    rng = random.Random(size)
    data = bytes(rng.randrange(256) for _ in range(size))
    for cut in {0, size // 3, size}:
        block = bytearray(data)
        infill.rotate(block, 0, cut, size)
        assert bytes(block) == data[cut:] + data[:cut]


def test_query_restores_every_document(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_fill_in_middle"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["restored_sha256"] for r in rows} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in docs.items()}
    assert {r["form"] for r in rows} >= {"psm", "spm"}
