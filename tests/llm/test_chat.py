import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import EXTRA

from foliant.llm import chat
from foliant.llm.common import new_path

ROWS = [
    (1, 1, "user", r"a\b</s>\[INST]<|turn|>"), (1, 2, "assistant", "\\"), (1, 2, "assistant", None),
    (1, 2, "assistant", "\\"), (1, 3, None, "<|none|>\n<\\s><|says|><<|says|>"), (None, 1, "<|end|>", "x\\\n"),
    (2, None, "assistant", ""), (2, 5, "user", "tail"), (3, 1, "system", "only"), (4, 1, "assistant", "ü😀" * 5000),
]


def table(spark, rows):
    extra = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(
        [(*r, *["x"] * len(EXTRA)) for r in rows], f"conv_id long, turn long, role string, text string, {extra}"
    )


def ordered(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn, role, text))
    none_first = lambda x: [(v is not None, v or 0 if k == 0 else v or "") for k, v in enumerate(x)]
    return {c: sorted(x, key=none_first) for c, x in found.items()}


def test_round_trip(spark):
    found = {r.conv_id: r for r in chat.round_trip(table(spark, ROWS)).collect()}
    wanted = ordered(ROWS)
    assert found.keys() == wanted.keys()
    for conv, turns in wanted.items():
        r, loss = found[conv], "".join(t or "" for _, role, t in turns if role == "assistant")
        whole = "".join(f"{role or ''}\n{t or ''}\n" for _, role, t in turns)
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.n_examples == sum(role == "assistant" for _, role, _ in turns)
    assert chat.round_trip(table(spark, [])).count() == 0


def test_examples_have_all_turns_before_and_one_target(spark):
    text, examples = chat.write_examples(table(spark, ROWS), new_path(spark, "chat-test"))
    found = chat.example_texts(text, examples).collect()
    wanted = []
    for conv, turns in ordered(ROWS).items():
        for n, (_, role, target) in enumerate(turns):
            if role == "assistant":
                wanted.append((conv, n, target or ""))
    got = []
    for r in found:
        assert not any(mark in r.target for mark in chat.CONTROL)
        got.append((r.conv_id, r.context.count(chat.OPEN) - 1, chat.unescape(r.target)))
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_written_examples_hold_their_context(spark):
    _, examples = chat.write_examples(table(spark, ROWS), new_path(spark, "chat-test"))
    got = sorted(((r.conv_id, r.example, r.place) for r in examples.collect()), key=repr)
    wanted = []
    for conv, turns in ordered(ROWS).items():
        replies = [n for n, (_, role, _) in enumerate(turns) if role == "assistant"]
        wanted += [(conv, k, place) for k, last in enumerate(replies, 1) for place in range(last + 1)]
    assert got == sorted(wanted, key=repr)


def test_a_missing_turn_of_a_context_is_an_error(spark):
    text, examples = chat.write_examples(table(spark, ROWS), new_path(spark, "chat-test"))
    with pytest.raises(Exception, match="lacks part of its context"):
        chat.read_back(text, examples.where("NOT (conv_id = 1 AND example = 2 AND place = 0)")).collect()


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["\\", "<", "|", ">", "s", "/", "[", "INST]", "</s>", "<|end|>", "e"])).map("".join), max_size=30))
def test_escapes_are_reversible(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", chat.escape(rows.t).alias("e")).collect():
        assert chat.unescape(r.e) == r.t
        assert not any(mark in r.e for mark in [*chat.CONTROL, chat.NULL_ROLE])
