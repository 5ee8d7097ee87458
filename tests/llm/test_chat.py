import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from roadflux.llm import chat

PARTS = [*"<>[]/\\s|:1 \n", "<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "[/TURN]", "INST]", "<|image:0|>", "<|audio:12|>", "s>", "ü", "😀"]
texts = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    hidden = chat.escaped(text)
    assert chat.unescaped(hidden) == text
    assert not any(mark in hidden for mark in ("<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "[/TURN]"))
    assert not chat._PLACEHOLDER.search(hidden)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a b\n]", ""]), texts), max_size=6))
def test_turns_come_back(turns):
    whole = "".join(chat.framed(role, chat.escaped(text))[0] for role, text in turns)
    assert [(role, "".join(p["text"] for p in parts)) for role, parts in chat.turns_of(whole)] == turns


def expected(turns):
    own = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), own, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def digest_rows(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}


@pytest.mark.parametrize("piece", [1, 60, chat.PIECE])
def test_digests_are_those_of_the_input_whatever_the_pieces(spark, piece):
    rng = random.Random(3)
    want, rows = {}, []
    for conv in [*range(12), None, -1]:
        turns = [(rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice([None, "", "plain", "".join(rng.choices(PARTS, k=20))])) for _ in range(rng.randint(1, 9))]
        want[conv] = expected(turns)
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    pieces = chat.formatted(frame, piece=piece)
    assert digest_rows(chat.digests(pieces)) == want
    total = sum(len(r.formatted) for r in pieces.collect())
    assert sum(r.formatted_chars for r in chat.digests(pieces).collect()) == total


def test_typed_parts(spark):
    text = lambda t: ("text", t, None, None, None, None, None)
    content = [
        (1, 0, "user", [text("look: <"), text("s>"), ("image", None, "s3://a.png", 100, 57, None, None), text("and"), ("audio", None, "b.wav", None, None, 2.01, None)]),
        (1, 1, "assistant", [text("<|image:0|>"), ("document", None, "c.pdf", None, None, None, 3), ("video", None, "d.mp4", None, None, None, None), None]),
        (1, 2, "assistant", None), (2, 0, "user", []), (2, 1, "user", [("image", None, None, None, None, None, None)]),
    ]
    schema = chat.T.StructType([chat.T.StructField("conv_id", chat.T.LongType()), chat.T.StructField("turn", chat.T.LongType()),
                                chat.T.StructField("role", chat.T.StringType()), chat.T.StructField("parts", chat.T.ArrayType(chat.PART))])
    pieces = {r.conv_id: r for r in chat.formatted(spark.createDataFrame(content, schema), content_col="parts").collect()}
    first = pieces[1]
    assert first.formatted == r"<s>[INST] look: <\s><|image:0|>and<|audio:1|> [/INST] <\|image:0|><|document:2|><|other:3|></s> </s>"
    assert [(a.k, a.turn, a.type, a.ref, a.tokens) for a in first.attachments] == [
        (0, 0, "image", "s3://a.png", 4 * 3), (1, 0, "audio", "b.wav", 51), (2, 1, "document", "c.pdf", 3 * 512), (3, 1, "video", "d.mp4", 0)]
    assert first.expanded_tokens == 12 + 51 + 1536
    back = list(chat.turns_of(first.formatted, [a.asDict() for a in first.attachments]))
    assert [role for role, _ in back] == ["user", "assistant", "assistant"]
    assert [p.get("text", p.get("ref")) for p in back[0][1]] == ["look: <s>", "s3://a.png", "and", "b.wav"]
    assert [p.get("text", p.get("ref")) for p in back[1][1]] == ["<|image:0|>", "c.pdf", "d.mp4"] and back[2][1] == []
    assert [first.formatted[s.begin:s.end] for s in first.loss] == [r"<\|image:0|><|document:2|><|other:3|>", ""]
    assert pieces[2].formatted == "<s>[INST]  [/INST]<s>[INST] <|image:0|> [/INST]" and pieces[2].attachments[0].tokens == 0


def test_ties_repeated_rows_and_extra_columns(spark):
    rows = [(1, 0, "user", "b", "x", 1), (1, 0, "user", "a", "x", 1), (1, 0, "assistant", "c", "x", 1), (1, 0, "user", "a", "x", 1), (1, None, "system", "first", "x", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, piece int")
    want = expected([("system", "first"), ("assistant", "c"), ("user", "a"), ("user", "a"), ("user", "b")])
    assert digest_rows(chat.digests(chat.formatted(frame))) == {1: want}


def test_empty_table_and_long_text(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.digests(chat.formatted(spark.createDataFrame([], schema))).collect() == []
    long = "a [INST] <s> " * 200_000
    got = digest_rows(chat.digests(chat.formatted(spark.createDataFrame([(1, 0, "assistant", long)], schema))))
    assert got == {1: expected([("assistant", long)])}
