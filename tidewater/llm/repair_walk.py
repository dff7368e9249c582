"""The dynamic program behind conversation repair, over the codes of a run of turns.

A repaired conversation reads ``(s?(ua)+)?`` in role initials. States: 0 nothing
yet, 1 after a system turn, 2 after a user, 3 after an assistant. A turn's code is
``3 * initial + fault``: initial 0 system, 1 user, 2 assistant, 3 other; fault 0
none, 1 must be deleted, 2 truncated.

Edits are one character each: ``K`` keeps a turn, ``D`` deletes it, ``U`` and ``A``
make it a user's or an assistant's, ``u`` and ``a`` insert an empty turn before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from math import isqrt

Vector = tuple[int, int, int, int]

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1  # costs
MUST_DELETE, CUT = 1, 2  # faults
FAR = 1 << 28
END: Vector = (0, 2 * INSERT, INSERT, 0)  # what is left to pay after the last turn
FILL = (2, 2, 3, 2)  # state after a turn whose role may be chosen
KEEP = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))  # state and initial
AUDIT = str.maketrans("uaUA", "IIRR")


def before(code: int, v: Vector) -> Vector:
    """Least costs from each state before a turn, given those after it."""
    initial, fault = divmod(code, 3)
    if fault == MUST_DELETE:
        b = [DELETE + x for x in v]
    else:
        extra = TRUNCATED if fault == CUT else 0
        b = []
        for s in range(4):
            least = min(DELETE + v[s], REROLE + extra + v[FILL[s]])
            t = KEEP[s][initial]
            b.append(least if t is None else min(least, extra + v[t]))
    two = min(b[2], INSERT + b[3])
    return min(b[0], INSERT + two), min(b[1], INSERT + two), two, min(b[3], INSERT + b[2])


def sweep(codes: Sequence[int], v: Vector) -> Vector:
    for code in reversed(codes):
        v = before(code, v)
    return v


def transfer(codes: Sequence[int]) -> list[int]:
    """Least costs from each state before a run of turns to each state after it,
    row by row: vectors pass a run by a (min, +) product."""
    by_end = [sweep(codes, tuple(0 if s == t else FAR for s in range(4))) for t in range(4)]
    return [by_end[t][s] for s in range(4) for t in range(4)]


def through(matrix: Sequence[int], v: Vector) -> Vector:
    return tuple(min(matrix[4 * s + t] + v[t] for t in range(4)) for s in range(4))


def _step(code: int, state: int, here: Vector, after: Vector) -> tuple[str, int]:
    """The least edits in ASCII order of initials (D, I, K, R) that stay cheapest,
    up to the turn's own edit, and the state after it."""
    initial, fault = divmod(code, 3)
    extra = TRUNCATED if fault == CUT else 0
    edits = ""
    while True:
        left = here[state]
        if left == DELETE + after[state]:
            return edits + "D", state
        fill = FILL[state]
        if left == INSERT + here[fill]:
            edits, state = edits + ("u" if fill == 2 else "a"), fill
            continue
        kept = KEEP[state][initial]
        if kept is not None and left == extra + after[kept]:
            return edits + "K", kept
        return edits + ("U" if fill == 2 else "A"), fill


def walks(codes: Sequence[int], v: Vector) -> list[tuple[str, int]]:
    """Edits and end state from each start state of a run that ``v`` follows.

    The backward vectors are kept at checkpoints about the square root of the
    length apart; walking forward recomputes those of one part at a time."""
    part = isqrt(len(codes)) + 1
    starts = range(0, len(codes), part)
    checkpoints = [v]
    for at in reversed(starts):
        checkpoints.append(sweep(codes[at : at + part], checkpoints[-1]))
    edits, state = [[] for _ in range(4)], list(range(4))
    for k, at in enumerate(starts):
        vectors = [checkpoints[len(starts) - 1 - k]]  # after the part
        for code in reversed(codes[at : at + part]):
            vectors.append(before(code, vectors[-1]))
        for i, code in enumerate(codes[at : at + part]):
            here, after = vectors[-1 - i], vectors[-2 - i]
            done: dict[int, tuple[str, int]] = {}
            for start in range(4):
                s = state[start]
                if s not in done:
                    done[s] = _step(code, s, here, after)
                edits[start].append(done[s][0])
                state[start] = done[s][1]
    return [("".join(e), s) for e, s in zip(edits, state, strict=True)]


def tail(state: int) -> str:
    """The turns inserted after the last one."""
    return {0: "", 1: "ua", 2: "a", 3: ""}[state]


# short runs, those of ordinary conversations, occur again and again
_short_transfer = lru_cache(20_000)(transfer)
_short_walks = lru_cache(20_000)(walks)
SHORT = 32


def cached_transfer(codes: bytes) -> list[int]:
    return _short_transfer(codes) if len(codes) <= SHORT else transfer(codes)


def cached_walks(codes: bytes, v: Vector) -> list[tuple[str, int]]:
    return _short_walks(codes, v) if len(codes) <= SHORT else walks(codes, v)
