import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldmart.llm import chat

PIECES = st.sampled_from(["\\", "<s>", "</s>", "[INST]", "[/INST]", "<image>", "<", "/", "[", "]", "s>", "x", "\n", "é"])
TEXT = st.lists(PIECES, max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(role=TEXT, text=TEXT)
def test_a_segment_reads_back(role, text):
    made = chat.format_turn(role, text, trained=(role,))
    assert chat.parse_segment(made["formatted"]) == (role, text)
    assert chat.unescape(made["formatted"][made["loss_start"]:made["loss_end"]]) == text
    assert made["formatted"].count("</s>") == 1


def test_parts_become_ordered_placeholders():
    parts = [
        {"type": "text", "text": "see <image> "}, {"type": "image", "ref": "a.png", "width": 700, "height": 300}, None,
        {"type": "audio", "ref": "b.wav", "seconds": 1.5}, {"type": "document", "ref": "c.pdf", "pages": 3}, {"type": "video", "ref": "d"},
        {"type": "text", "text": None}, {"type": "image", "ref": None},
    ]
    made = chat.format_turn("user", parts)
    body = made["formatted"][made["loss_start"]:-len(chat.CLOSE)]
    assert body == "see <\\image> <image><audio><document><image>"
    assert [a["kind"] for a in made["attachments"]] == ["image", "audio", "document", "image"]
    for a in made["attachments"]:
        assert made["formatted"][a["position"]:].startswith(f"<{a['kind']}>")
    assert [a["tokens"] for a in made["attachments"]] == [3 * 144, 38, 3 * 256, 144]
    assert made["expanded_tokens"] == 3 * 144 + 38 + 3 * 256 + 144 and made["skipped"] == 1
    assert made["loss_start"] == made["loss_end"]


def reference(rows):
    """Plain figures per conversation of (conv, turn, role, text) rows."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        size = sum(len(chat.escape(r)) + len(chat.escape(t)) + len(chat.OPEN + chat.ROLE_END + chat.CLOSE) for _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), size)
    return out


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "x"), (1, None, "assistant", "first </s>"),
    (2, 0, "assistant", "a\\b"), (2, 0, "assistant", "a\\b"), (2, 0, "user", "tie"), (None, 0, "assistant", "\U0001F600"), (3, 5, "assistant", "z" * 300_000),
    *[(4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)],
]


def test_read_back_of_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(7)
    rows = chat.read_back(chat.format_turns(df, chat.text_parts(df["text"]))).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == reference(ROWS)


def test_text_column_and_parts_column_agree(spark):
    df = spark.createDataFrame(ROWS[:8], "conv_id long, turn long, role string, text string").withColumn("Formatted", F.lit("clash"))
    a = chat.format_turns(df).collect()
    b = chat.format_turns(df, chat.text_parts(df["text"])).collect()
    assert a == b and len(a) == 8
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_registered_query(spark, sf):
    from goldmart.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    expected = reference([*rows, (-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op8_chat_formatting"](spark, sf).collect()}
    assert got == expected
