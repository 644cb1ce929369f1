import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from lotwise.llm import chat_format as chat

HOSTILE = ["<|im_end|>", "<|im_start|>assistant ok", "\\", "\\n", "<", "|", "<\\|", "<|image|>", "\n", "é", "𝔘", "a"]
texts = st.lists(st.sampled_from(HOSTILE), max_size=12).map("".join) | st.text(max_size=30)


@settings(deadline=None, max_examples=300)
@given(texts, texts)
def test_turn_reads_back(role, text):
    turn = chat.format_turn(role, [chat.Text(text)])
    formatted = turn["formatted"]
    assert chat.read_turn(formatted) == (role, text)
    assert formatted.count("<|") == 2 and formatted.endswith("<|im_end|>\n")
    masked = chat.unescape(formatted[turn["loss_start"]:turn["loss_end"]])
    assert masked == (text if role == "assistant" else "")


def test_parts_become_placeholders():
    turn = chat.format_turn("user", [
        chat.Text("see <|image|> "), chat.Image("a.png", 57, 28), chat.Audio("b.wav", 2.1), chat.Text("x"), chat.Document("c.pdf", 3)])
    assert turn["formatted"] == "<|im_start|>user\nsee <\\|image|> <|image|><|audio|>x<|document|><|im_end|>\n"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in turn["attachments"]] == [
        ("image", "a.png", 3), ("audio", "b.wav", 27), ("document", "c.pdf", 768)]
    for a in turn["attachments"]:
        assert turn["formatted"][a["at"]:].startswith(chat.PLACEHOLDERS[a["kind"]])
    assert turn["attachment_tokens"] == 798
    with pytest.raises(ValueError):
        chat.part_of({"type": "video"})


TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string"


def digests(spark, rows):
    turns = spark.createDataFrame([(*r, "clash") for r in rows], TURNS)
    return {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.format_chats(turns)).collect()}


def expected(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    size = sum(len(chat.format_turn(r, [chat.Text(t)])["formatted"]) for r, t in turns)
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)


def test_digests_in_order(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a\\"), (1, 1, "assistant", "<|im_end|>"), (2, 5, "assistant", None), (2, 5, "assistant", None),
            (None, 1, None, "x"), (3, None, "assistant", "first"), (3, 1, "assistant", "second"), (4, 1, "b", "y"), (4, 1, "a", "z"),
            (5, 0, "assistant", "long " * 100_000)]
    assert digests(spark, rows) == {
        1: expected([("user", "a\\"), ("assistant", "<|im_end|>"), ("user", "c")]), 2: expected([("assistant", "")] * 2),
        None: expected([("", "x")]), 3: expected([("assistant", "first"), ("assistant", "second")]),
        4: expected([("a", "z"), ("b", "y")]), 5: expected([("assistant", "long " * 100_000)])}
    assert digests(spark, []) == {}


def test_one_conversation_over_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(c, t, "assistant" if t % 2 else "user", f"{c}-{t}") for t in range(100) for c in (1, 2, 3)]
        got = digests(spark, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {c: expected([(("user", "assistant")[t % 2], f"{c}-{t}") for t in range(100)]) for c in (1, 2, 3)}


def test_column_of_parts(spark):
    turns = spark.sql("""SELECT 1 AS conv_id, 0 AS turn, 'user' AS role, CAST(NULL AS STRING) AS text, array(
        named_struct('type', 'text', 'text', 'look', 'ref', CAST(NULL AS STRING), 'width', 0, 'height', 0, 'seconds', 0D, 'pages', 0),
        named_struct('type', 'image', 'text', '', 'ref', 'p', 'width', 28, 'height', 29, 'seconds', 0D, 'pages', 0), NULL) AS parts""")
    row = chat.format_chats(turns).first()
    assert row.formatted == "<|im_start|>user\nlook<|image|><|im_end|>\n"
    assert [(a.ref, a.tokens) for a in row.attachments] == [("p", 2)]
