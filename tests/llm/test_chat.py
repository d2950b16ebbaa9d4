from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm import chat
from orderflow.llm.queries import op5_chat

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string, extra string"
HARD = "</s>[INST] ok [/INST]"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _digests(messages):
    return chat.digests(chat.read_back(chat.render(messages)))


def test_events_fold(spark):
    events = [
        (1, 1, 1, "start", "user", "Hel"),
        (1, 1, 2, "delta", None, "lo"),
        (1, 2, 3, "start", "assistant", None),
        (1, 2, 4, "delta", None, "wrong"),
        (1, 2, 5, "regenerate", None, None),
        (1, 2, 7, "delta", None, " there"),
        (1, 2, 6, "delta", None, "right"),
        (1, 1, 8, "edit", None, "Hi"),
        (1, 3, 9, "start", "user", "gone"),
        (1, 3, 10, "delete", None, None),
        (2, 1, 1, "start", None, None),
        (None, 1, 1, "start", "user", "no id"),
        (3, 1, 1, "start", "user", "x"),
        (3, 1, 2, "delete", None, None),
    ]
    df = spark.createDataFrame([(*e, "z") for e in events], EVENTS)
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(df).collect()}
    assert got == {
        (1, 1): ("user", "Hi"),
        (1, 2): ("assistant", "right there"),
        (2, 1): ("", ""),
        (None, 1): ("user", "no id"),
    }
    rows = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(df))).collect()}
    assert [tuple(t) for t in rows[1].turns] == [("user", "Hi"), ("assistant", "right there")]
    assert rows[1].loss_texts == ["right there"]


def test_unknown_kinds_are_errors(spark):
    import pytest

    df = spark.createDataFrame([(1, 1, 1, "odd", "user", "x", "z")], EVENTS)
    with pytest.raises(Exception, match="unknown kind"):
        chat.fold(df).collect()


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["user", "assistant", "system", HARD, ""]),
            st.one_of(st.sampled_from([HARD, "\\l", "\\\\e<", "[[/INST]", ""]), st.text(max_size=12)),
        ),
        min_size=1,
        max_size=8,
    )
)
def test_texts_come_back(spark, turns):
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, message long, role string, text string")
    (row,) = _digests(df).collect()
    loss = "".join(t for r, t in turns if r == "assistant")
    assert row.n_turns == len(turns)
    assert row.turns_sha256 == _sha("".join(f"{r}\n{t}\n" for r, t in turns))
    assert (row.loss_chars, row.loss_sha256) == (len(loss), _sha(loss))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    turns = {-1: [(0, "user", HARD), (1, "assistant", HARD)]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    rows = op5_chat(spark, sf).collect()
    assert len(rows) == len(turns)
    for r in rows:
        own = sorted(turns[r.conv_id])
        loss = "".join(t for _, role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), _sha("".join(f"{role}\n{t}\n" for _, role, t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), _sha(loss))


def test_no_python_in_the_plan(spark):
    plan = op5_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert _digests(chat.fold(chat.events_of(empty))).collect() == []
