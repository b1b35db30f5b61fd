"""Chat formatting: folding of events, reversible escaping, digests read back."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revloom.llm import chat
from revloom.llm.queries import QUERIES

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string, start int, formatted string"
TEXT = st.text(alphabet=st.one_of(st.sampled_from("\\#</turn>: \nok"), st.characters(exclude_categories=["Cs"])), max_size=40)


def digests(conv, turns):
    """What the query must give for [(role, text)]."""
    learned = [t for r, t in turns if r == "assistant"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, learned)), sha("".join(learned))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    by = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    rows = QUERIES["op2_chat_formatting"](spark, folder).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(digests(c, t) for c, t in by.items())
    length = {r["conv_id"]: r["formatted_chars"] for r in rows}
    assert all(length[c] == sum(len(chat.render(*x)[0]) for x in t) for c, t in by.items())


@settings(max_examples=500, deadline=None)
@given(TEXT, TEXT)
def test_turns_read_back(role, text):
    segment, a, b = chat.render(role, text)
    assert chat.read_turn(segment) == (role, text) and chat.unescape(segment[a:b]) == text
    body = segment[len(chat.OPEN) : -len(chat.CLOSE)]
    assert "###" not in body and "</turn>" not in body


def fold_plain(events):
    """Messages of one conversation, replaying its log in the order of seq."""
    state = {}
    for message, _, kind, role, text in sorted(events, key=lambda e: e[1]):
        if kind == "regenerate":
            for m in [m for m in state if m > message]:
                del state[m]
        old = state.get(message, ("", ""))
        new = {"delta": old[1] + (text or ""), "edit": text or "", "regenerate": ""}[kind]
        state[message] = (role or old[0], new)
    return [state[m] for m in sorted(state)]


def test_fold_equals_replay(spark):
    draw = random.Random(4)
    logs = {}
    for conv in range(40):
        logs[conv] = [(draw.randrange(5), seq, draw.choice(["delta"] * 5 + ["edit", "regenerate"]), draw.choice(["user", "assistant"]), f"{draw.random():.3f}#</turn>")
                      for seq in range(draw.randrange(1, 30))]
    rows = [(c, *e, 1, "x") for c, log in logs.items() for e in log]
    draw.shuffle(rows)
    turns = chat.formatted(spark.createDataFrame(rows, EVENTS).repartition(4))
    got = {}
    for r in turns.orderBy("conv_id", "position").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    expected = {c: fold_plain(log) for c, log in logs.items()}
    texts = lambda x: {c: [t for _, t in m] for c, m in x.items()}
    assert texts(got) == texts(expected)
    back = {r["conv_id"]: tuple(r)[:5] for r in chat.read_back(turns).collect()}
    assert back == {c: digests(c, m) for c, m in got.items()}


def test_odd_rows(spark):
    said = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, 1, "assistant", "tie"), (2, None, None, "x" * 200_000), (None, 0, "assistant", "no number"),
            (3, 0, "a: b\\", "### a: b</turn>\n### assistant: c</turn>\n")]
    table = spark.createDataFrame([(*r, "q") for r in said], "conv_id long, turn long, role string, text string, seq string")
    got = {r["conv_id"]: tuple(r)[:5] for r in chat.read_back(chat.formatted(chat.message_events(table.repartition(3)), by=chat.MESSAGE_ORDER)).collect()}
    ties = sorted(["", "", "tie"], key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert got == {c: digests(c, t) for c, t in {
        1: [("user", ""), *[("assistant", t) for t in ties]], 2: [("", "x" * 200_000)], None: [("assistant", "no number")], 3: [(said[-1][2], said[-1][3])],
    }.items()}
    empty = spark.createDataFrame([], EVENTS)
    assert chat.formatted(empty).collect() == [] and chat.read_back(chat.formatted(empty)).collect() == []


def test_what_was_not_rendered_raises():
    for bad in ("### user: x", "user: x</turn>\n", "### user: a</turn> b</turn>\n"):
        with pytest.raises(ValueError):
            chat.read_turn(bad)
