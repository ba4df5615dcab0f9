import math
import random
import re
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from goldmart.llm import fertility
from goldmart.llm.queries import QUERIES
from tests.llm.conftest import SF_SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = fertility.model_bytes(PATH)
CUTTER = sentencepiece.SentencePieceProcessor(model_file=PATH)


def plain(text):
    """The counts and figures by rule."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    tokens = [t for w in words for i in range(0, len(w), fertility.LONG) for t in CUTTER.encode(w[i:i + fertility.LONG])]
    chars, share = sum(map(len, words)), [n / len(tokens) for n in Counter(tokens).values()]
    figures = (chars / len(tokens), sum(map(CUTTER.is_byte, tokens)) / len(tokens), -sum(s * math.log2(s) for s in share)) if tokens else (0.0, 0.0, 0.0)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), chars, sum(c in "#*$%&|<>" for w in words for c in w), sum(Counter(lines).values()) - len(set(lines)), len(inside), len(tokens)), figures, failed


def check(rows):
    for r in rows:
        counts, figures, failed = plain(r["text"])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")) == counts, r["text"]
        assert all(math.isclose(r[n], v, abs_tol=1e-9) for n, v in zip(fertility.FIGURES, figures))
        assert r["base_failed"] == failed
        low, high, most, least = fertility.BANDS[r["script"]]
        assert r["kept"] == (not failed and low <= figures[0] <= high and figures[1] <= most and figures[2] >= least)


PROSE = "When the river rose in the spring, the people of the valley moved their cattle to the higher meadows and waited there for the water to fall again. "
TEXTS = [
    None, "", " \t\n", "one", "a b c a b c a b c", "x " * 60, "a\nb\na\n \n \na", PROSE * 1 + "They kept small fires burning, told stories about older floods, and mended whatever tools had broken since autumn came; nobody slept much, yet children laughed among sheep while grandmothers counted bread.",
    "    \x1c\x1d", "\U0001F600 ￿" * 40, "#$% <b> | & *** a", "é" * 5000, "日本語のテキスト " * 60, "привет мир " * 5, "x" * 200_000,
    " ".join(f"w{i}" for i in range(30_000)), "12 34 56 " * 30,
]


def test_rows_equal_the_plain_rule(spark):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice(["a", "b", "c", "dé", "e\n", "#f"]) for _ in range(rng.randint(0, 80))) for _ in range(100)] + [TEXTS[7]] * 3
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, Kept int").repartition(3)
    judged = fertility.judge(df, MODEL)
    assert [c.lower() for c in judged.columns].count("kept") == 1
    rows = judged.collect()
    assert len(rows) == len(texts)
    check(rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["kept"] and not by_id[0]["kept"]
    assert (by_id[12]["script"], by_id[13]["script"], by_id[16]["script"]) == ("kana", "cyrillic", "none")


def test_empty_table(spark):
    assert fertility.judge(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0


def test_memory_of_words_may_be_forgotten(spark, monkeypatch):
    monkeypatch.setattr(fertility, "KEEP_WORDS", 3)
    words = fertility.Words(MODEL)
    for text in ("a b c d e", "c d x y z", "a a b"):
        numbers = words.number(text.encode().split())
        words.learn()
        tokens = [t for w in text.split() for t in CUTTER.encode(w)]
        assert words.figures(numbers, len(text.replace(" ", "")))[0] == len(tokens)
        words.forget()


def test_bands_reject_noise_and_keep_prose(spark):
    rng = random.Random(9)
    noise = " ".join("".join(chr(rng.randrange(0x0250, 0x02AF)) for _ in range(9)) for _ in range(80))
    litter = " ".join(rng.choice(["<<<<", ">>>>", "aa"]) for _ in range(300))
    rows = fertility.judge(spark.createDataFrame([(0, noise), (1, TEXTS[7]), (2, litter)], "doc_id long, text string"), MODEL).collect()
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert kept[1] and not kept[2]
    tight = fertility.judge(spark.createDataFrame([(0, noise)], "doc_id long, text string"), MODEL, bands={**fertility.BANDS, "other": (1.0, 9.0, 0.5, 3.0)})
    assert not tight.first()["kept"]


def test_learned_bands_hold_the_corpus(spark):
    judged = fertility.judge(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"), MODEL).cache()
    bands = fertility.learn_bands(judged)
    low, high, most, least = bands["latin"]
    assert bands["han"] == fertility.BANDS["han"] and low < high
    good = judged.where("not base_failed")
    inside = good.where(F.col("chars_per_token").between(low, high) & (F.col("byte_share") <= most) & (F.col("token_entropy") >= least)).count()
    assert inside >= 0.95 * good.count()


def test_query_equals_the_plain_rule_on_all_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op12_quality_rules"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, figures, failed = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts[:5]
        assert r["base_failed"] == failed and math.isclose(r["token_entropy"], figures[2], abs_tol=1e-9)
