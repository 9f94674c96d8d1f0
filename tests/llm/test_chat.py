"""Chat formatting: round trips, spans of black-box templates, and templates that rewrite history."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketframe.llm import chat

PARTS = ["</s>", "<s>", "[INST]", "[/INST]", " [/INST]", "[SYS]", "[SAYS]", " [SAYS] ", "[/ROLE]", "\\", "<\\/s>", "[\\\\INST]", "<", "[", " ", "\n", "é🙂", "ok"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST] "]), TEXT), max_size=6)


@settings(max_examples=400, deadline=None)
@given(TURNS)
def test_round_trip_and_loss_spans(turns):
    formatted, spans, loss, rewritten = chat.render(turns, chat.instruct_template)
    assert chat.read_back(formatted) == turns and not rewritten
    assert "".join(formatted[a:b] for a, b in spans) == formatted[len(chat.BEGIN) :]
    assert [chat.unescape(formatted[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


def names_then_text(turns):
    return "".join(f"<{role}>{text}</{role}>\n" for role, text in turns)


def test_spans_of_another_template():
    turns = [("user", "A"), ("assistant", "</assistant>"), ("assistant", ""), ("assistant", "AA")]
    formatted, spans, loss, _ = chat.render(turns, names_then_text)
    assert [formatted[a:b] for a, b in loss] == ["</assistant>", "", "AA"]
    assert [formatted[a:b] for a, b in spans] == [names_then_text([t]) for t in turns]


def test_rewritten_history_is_reported_and_trains_nothing(spark):
    def drops_old_thoughts(turns):
        return "|".join(t if n == len(turns) - 1 else t.split("###")[-1] for n, (_, t) in enumerate(turns))

    turns = [("user", "hi"), ("assistant", "hmm###yes"), ("user", "so"), ("assistant", "x###y"), ("user", "end")]
    formatted, spans, loss, rewritten = chat.render(turns, drops_old_thoughts)
    assert (spans, loss, rewritten) == ([], [], [3, 5]) and formatted == "hi|yes|so|y|end"
    frame = spark.createDataFrame([(1, n, r, t) for n, (r, t) in enumerate(turns)] + [(2, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r for r in chat.format_chats(frame, drops_old_thoughts).collect()}
    assert rows[1].rewritten == [3, 5] and rows[1].loss == [] and rows[2].rewritten == [] and len(rows[2].spans) == 1


def test_nulls_repeats_gaps_and_clashing_columns(spark):
    rows = [
        (1, 5, "assistant", None, "x", 1), (1, 2, None, "q", "x", 1), (1, None, "user", "first", "x", 1), (1, 5, "assistant", "a", "x", 1),
        (1, 5, "assistant", "a", "x", 1), (None, 0, "user", "u", "x", 1), (3, 0, "assistant", "long " * 20000, "x", 1),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, spans int")
    got = {r.conv_id: r for r in chat.texts_read_back(chat.format_chats(frame)).collect()}
    assert set(got) == {None, 1, 3}
    assert got[1].turns_text == "user\nfirst\n\nq\nassistant\n\nassistant\na\nassistant\na\n"
    assert (got[1].n_turns, got[1].loss_text) == (5, "aa") and got[3].loss_text == "long " * 20000
    assert chat.format_chats(frame.limit(0)).collect() == []


def test_query_columns(spark):
    folder = "/root/testdata/sf0.001"
    try:
        turns = spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect()
    except Exception:
        pytest.skip("test tables are not there")
    expected = {}
    for r in turns:
        expected.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    said = "</s>[INST] ok [/INST]"
    expected[-1] = [("user", said), ("assistant", said)]
    rows = {r.conv_id: r for r in chat.op10_chat_formatting(spark, folder).collect()}
    assert rows.keys() == expected.keys()
    for i, own in expected.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert rows[i].n_turns == len(own) and rows[i].loss_chars == len(loss)
        assert rows[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert rows[i].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert rows[i].formatted_chars == len(chat.instruct_template(own))
