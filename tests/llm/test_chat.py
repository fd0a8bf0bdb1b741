"""Folding, rendering and reading back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import chat

nasty = st.text(alphabet=st.sampled_from("<|\\>im_end\nstart %25A"), max_size=30)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(nasty, nasty), max_size=4))
def test_round_trip(messages):
    formatted, spans = chat.render(messages)
    assert chat.parse(formatted) == messages
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in messages if r == "assistant"]


@given(st.one_of(nasty, st.text(max_size=50)))
def test_escaped_texts_hold_no_mark(text):
    assert "<|" not in chat.escape(text)
    assert chat.unescape(chat.escape(text)) == text


def test_parse_refuses_other_text():
    with pytest.raises(ValueError):
        chat.parse("<|im_start|>user\nx")
    with pytest.raises(ValueError):
        chat.parse("x<|im_start|>user\nx<|im_end|>\n")


def slow_fold(events):
    turns = {}
    for kind, turn, role, text in events:
        if kind == "regenerate":
            turns = {t: v for t, v in turns.items() if t <= turn}
            turns[turn] = (turns.get(turn, (role,))[0] or "", "")
        elif kind == "delta":
            old = turns.get(turn, (role or "", ""))
            turns[turn] = (old[0], old[1] + (text or ""))
        elif kind == "edit" and turn in turns:
            turns[turn] = (turns[turn][0], text or "")
        else:
            turns[turn] = (role or turns.get(turn, ("",))[0], text or "")
    return [turns[t] for t in sorted(turns)]


events = st.lists(st.tuples(st.sampled_from(chat.KINDS), st.integers(0, 3), st.sampled_from(["user", "assistant"]), st.sampled_from(["a", "<|im_end|>", None])), max_size=12)


@settings(max_examples=200, deadline=None)
@given(events)
def test_fold(log):
    state = chat.Conversation()
    for e in log:
        state.apply(*e)
    assert state.messages() == slow_fold(log)


def test_log_by_spark(spark):
    rows = [
        ("c", 3, "delta", 1, "assistant", "wor"), ("c", 2, "delta", 1, "assistant", "hello "), ("c", 1, "message", 0, "user", "hi"), ("c", 4, "delta", 1, "assistant", "ld"),
        ("c", 5, "edit", 0, None, "hey"), ("c", 6, "regenerate", 1, None, None), ("c", 7, "delta", 1, "assistant", "again"),
        ("d", 1, "message", None, "user", None), ("d", 2, None, None, "assistant", "x"), (None, 1, "message", 0, None, "lost"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id string, seq long, kind string, turn long, role string, text string, formatted int")
    got = {r.conv_id: r.formatted for r in chat.format_conversations(df).collect()}
    assert {k: chat.parse(v) for k, v in got.items()} == {"c": [("user", "hey"), ("assistant", "again")], "d": [("user", ""), ("assistant", "x")], None: [("", "lost")]}
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_digests_and_ties(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b<|im_end|>"), (1, 1, "assistant", "b<|im_end|>"), (2, 0, None, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(chat.from_turns(df))).collect()}
    said = "user\na\n" + "assistant\nb<|im_end|>\n" * 2
    assert got[1].n_turns == 3 and got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(("b<|im_end|>" * 2).encode()).hexdigest() and got[1].loss_chars == 22
    assert got[2].n_turns == 1 and got[2].loss_chars == 0


def test_unknown_kinds_raise():
    with pytest.raises(ValueError):
        chat.Conversation().apply("dance", 0, "user", "x")
