"""Chat windows: read back against a plain walk, budget, repeats, odd texts."""

from __future__ import annotations

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from tidewater.llm import chat
from tidewater.llm.q_bpe import PRODUCTION_BPE
from tidewater.llm.q_chat import HOSTILE

SCHEMA = "conv_id long, turn long, role string, text string"


@given(st.text(alphabet="<\\|a im_end>\n%"))
def test_escapes_are_reversible_and_hide_control_strings(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def _rows():
    rnd = random.Random(5)
    rows = []
    for conv in range(25):
        turns = rnd.randint(1, 12)
        for t in range(turns):
            role = "system" if t == 0 and conv % 3 == 0 else ("user", "assistant")[t % 2]
            text = " ".join(rnd.choice(["word", "<|im_end|>", "<\\|", "é", "%0A", "\n"]) for _ in range(rnd.randint(0, 30)))
            rows.append((conv, t, role, text if rnd.random() > 0.05 else None))
    rows += [(90, 0, "user", HOSTILE), (90, 1, "assistant", HOSTILE), (91, 0, None, None), (None, 1, "assistant", "x"), (None, 0, "odd\n%role", "y")]
    rows += [(92, 3, "assistant", "twice"), (92, 3, "assistant", "twice"), (93, 0, "system", "long " * 400), (93, 1, "assistant", "long " * 400)]
    return rows


def test_windows_read_back_to_all_turns(spark):
    rows = _rows()
    windows = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), PRODUCTION_BPE, budget=200, history=60)
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    by: dict = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())

    several = 0
    for w in windows.collect():
        turns = chat.read_turns(w.formatted)
        assert len(turns) == w.n_repeated + w.n_new and w.n_new >= 1
        first_system = by[w.conv_id] and sorted(by[w.conv_id])[0][1] == "system"
        if w.window and first_system:
            assert turns[0][0] == "system"
        assert w.n_tokens <= 200 or w.n_new == 1
        several += w.window > 0 and w.n_repeated > int(bool(first_system))
        for span in w.loss_spans:
            assert w.formatted[span.start - len("assistant\n") : span.start] == "assistant\n" and w.formatted[span.end :].startswith(chat.END)
    assert several > 5


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA), PRODUCTION_BPE)).collect() == []


def test_tokens_are_counted_before_the_shuffle(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hello")], "conv_id long, turn int, role string, text string")
    plan = chat.format_conversations(turns, PRODUCTION_BPE)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    # from the result down to the scan: windows, then the shuffle, then the counts
    assert plan.index("MapInArrow") < plan.index("Exchange hashpartitioning(conv_id") < plan.index("ArrowEvalPython")


def test_hostile_roles_count_as_they_are_written(spark):
    roles = ["%\n" * 40, "<|im_end|>" * 12, "user"]
    rows = [(1, t, roles[t % 3], f"text {t}") for t in range(30)]
    windows = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), PRODUCTION_BPE, budget=400, history=100).collect()
    count = chat.codec(PRODUCTION_BPE).whole
    assert len(windows) > 3
    for w in windows:
        assert w.n_tokens <= 400 or w.n_new == 1
        # turns are counted one by one, so a window's tokens are those of its turns as written
        written = [f"{chat.START}{turn}" for turn in w.formatted.split(chat.START)[1:]]
        assert w.n_tokens == sum(len(count(turn)) for turn in written)
