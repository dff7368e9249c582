"""Conversation repair: against a plain search over all edits, blocks of few turns, odd rows."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidewater.llm import repair as rp
from tidewater.llm import repair_walk as rw
from tidewater.llm.q_repair import damage, report

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\f\r"
RIGHT = re.compile(r"(s?(ua)+)?")


def plain(rows):
    """The cheapest edits by a search over all of them, least initials first: cost, audit, repaired lines."""
    faults, seen = [], set()
    for role, text in rows:
        seen_before, shown = (role, text) in seen, text.rstrip(WHITE)
        seen.add((role, text))
        faults.append("blank" if not shown else "duplicate" if seen_before else "truncated" if shown[-1] not in ".!?" else None)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and RIGHT.fullmatch(roles):
            return cost, audit, list(lines), faults
        key = (i, roles[-1:], "" if "u" in roles else roles)
        if key in done:
            continue
        done.add(key)

        def go(price, edit, j, initial, line, cost=cost, audit=audit, roles=roles, lines=lines):
            grown = roles + initial
            if not initial or RIGHT.fullmatch(grown) or RIGHT.fullmatch(grown + "a") or RIGHT.fullmatch(grown + "ua"):
                heapq.heappush(heap, (cost + price, audit + edit, j, grown, lines + line))

        for name in ("user", "assistant"):
            go(2, "I", i, name[0], (f"{name}:",))
        if i < len(rows):
            role, text = rows[i]
            go(3, "D", i + 1, "", ())
            if faults[i] not in ("blank", "duplicate"):
                extra = int(faults[i] == "truncated")
                if role:
                    go(extra, "K", i + 1, role[0], (f"{role}:{text}",))
                for name in ("user", "assistant"):
                    go(2 + extra, "R", i + 1, name[0], (f"{name}:{text}",))
    raise AssertionError


def expect(conv_rows):
    """The whole report of one conversation's rows (turn, role, text) after damage."""
    said = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    rows = sorted(conv_rows, key=lambda r: (r[0] is not None, r[0] or 0, said(r[1], r[2])))
    cost, audit, lines, faults = plain([(r, t) for _, r, t in rows])
    turns = [r[0] for r in rows if r[0] is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(p[1][:1] + q[1][:1] not in ("su", "ua", "au") for p, q in zip(rows, rows[1:], strict=False)),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def _rows(seed=3, convs=60):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "ub", "s"]
    texts = ["Yes.", "No!", "cut", "cut", "Why?", "", " \t", None, "é.", "a. ", "b.\x0b\f", " ", "x" * 300 + "."]
    rows = []
    for conv in range(convs):
        for t in range(rnd.randint(0, 9)):
            good = rnd.random() < 0.6
            role = ("user", "assistant")[t % 2] if good else rnd.choice(roles)
            text = f"t{t}." if good else rnd.choice(texts)
            rows.append((conv, None if rnd.random() < 0.05 else t + (rnd.random() < 0.1), role, text))
    return rows + rows[::17] + [(None, 1, "user", "Hm."), (None, 0, None, None), (900, None, "user", "One."), (901, 5, "assistant", "")]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    out: dict = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_report_matches_plain_search(spark, monkeypatch, bits):
    monkeypatch.setattr(rp, "BLOCK_BITS", bits)  # blocks of 1, 2 and 4096 turns
    rows = _rows()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    hurt = damage(table)
    assert sorted(map(tuple, hurt.collect()), key=repr) == sorted(damaged(rows), key=repr)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in report(table, rp.repair_conversations(hurt)).collect()}
    after = by_conversation(damaged(rows))
    assert set(got) == {r[0] for r in rows}
    for conv, found in got.items():
        assert found == expect(after.get(conv, [])), (conv, after.get(conv))


@given(st.lists(st.sampled_from(range(12)), max_size=40), st.sampled_from([rw.END, (3, 1, 2, 0), (0, 0, 5, 1)]))
def test_walks_are_tight_and_least(codes, end):
    matrix = rw.transfer(codes)
    assert rw.through(matrix, end) == rw.sweep(codes, end)
    for start, (edits, state) in enumerate(rw.walks(codes, end)):
        paid = sum({"K": 0, "D": 3, "u": 2, "a": 2, "U": 2, "A": 2}[e] for e in edits)
        kept = [e for e in edits if e not in "ua"]
        assert len(kept) == len(codes)
        paid += sum(c % 3 == rw.CUT and e != "D" for c, e in zip(codes, kept, strict=True))
        assert paid + end[state] == rw.sweep(codes, end)[start]


def test_transfers_compose():
    rnd = random.Random(1)
    codes = [rnd.randrange(12) for _ in range(5000)]
    whole = rw.walks(codes, rw.END)[0]
    late = rw.sweep(codes[2000:], rw.END)
    first, state = rw.walks(codes[:2000], late)[0]
    assert (first + rw.walks(codes[2000:], rw.END)[state][0]) == whole[0]


def test_long_conversation_is_worked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(rp, "BLOCK_BITS", 6)
    rnd = random.Random(2)
    rows = [(7, t, rnd.choice(["user", "assistant"]), rnd.choice([f"t{t}.", "same.", ""])) for t in range(1500)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    done = rp.repair_conversations(table)
    got = report(table, done).collect()[0]
    assert done.blocks.count() >= 1500 // 64 and done.turns.select("id").distinct().count() == 1500
    assert tuple(got[c] for c in COLUMNS) == expect([r[1:] for r in rows])


def test_equal_rows_empty_table_and_extra_columns(spark):
    rows = [(1, 0, "user", "Hi.")] * 3 + [(1, 1, "assistant", "Ho.")]
    table = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA + ", fault string, id long")
    got = report(table, rp.repair_conversations(table)).collect()
    assert [(r.duplicate, r.cost, r.audit) for r in got] == [(2, 6, "KDDK")]
    assert report(table, rp.repair_conversations(table.limit(0))).collect()[0].audit == ""
    assert report(table.limit(0), rp.repair_conversations(table.limit(0))).collect() == []
    lines = rp.repair_conversations(table).rows.orderBy("id", "part").collect()
    assert [(r.role, r.text, r.edit) for r in lines] == [("user", "Hi.", "K"), ("assistant", "Ho.", "K")]
