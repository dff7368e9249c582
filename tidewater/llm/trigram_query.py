"""Boolean trigram queries of regular expressions.

Every text that a regular expression matches holds certain substrings of three
characters. ``trigram_query`` derives them from the expression's parse tree: the
result is an OR of ANDs, a set of sets of trigrams in ASCII lower case, so it
serves an index of lower-cased texts for expressions in either case. A set with
no trigram means that the expression demands none, and each text must be scanned.

For every part of the tree the walk knows the strings it can be (``exact``, if
few), else how those strings can begin and end (up to two characters), and the
trigrams that are certain inside. Joined parts add the trigrams that cross
their border.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from tidewater.llm.common import ASCII_LOWER, ASCII_UPPER

Query = frozenset  # of frozensets of trigrams: an OR of ANDs

ANY: Query = frozenset([frozenset()])
MOST_STRINGS = 16  # a part with more strings is described by its ends only; a border with more ends demands nothing
_FOLD = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def both(a: Query, b: Query) -> Query:
    return _least(x | y for x, y in product(a, b))


def either(a: Query, b: Query) -> Query:
    return _least([*a, *b])


def _least(terms) -> Query:
    """Without the terms that another one implies."""
    terms = set(terms)
    return frozenset(t for t in terms if not any(o < t for o in terms))


def of_strings(strings: frozenset[str]) -> Query:
    """One of the strings occurs."""
    return _least(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


@dataclass(frozen=True)
class Part:
    exact: frozenset[str] | None
    first: frozenset[str] = frozenset([""])
    last: frozenset[str] = frozenset([""])
    inside: Query = ANY

    def loose(self) -> Part:
        """Described by ends and trigrams, not by whole strings."""
        if self.exact is None:
            return self
        if len(self.exact) > MOST_STRINGS:
            return UNKNOWN
        return Part(None, frozenset(s[:2] for s in self.exact), frozenset(s[-2:] for s in self.exact), of_strings(self.exact))


EMPTY, UNKNOWN = Part(frozenset([""])), Part(None)


def _bounded(part: Part) -> Part:
    return part.loose() if part.exact is not None and len(part.exact) > MOST_STRINGS else part


def _joined(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return Part(frozenset(x + y for x, y in product(a.exact, b.exact)))
    if a.exact is not None and b.exact is not None and len(a.exact) < len(b.exact):
        b = b.loose()
    elif a.exact is not None and b.exact is not None:
        a = a.loose()
    ends = a.exact if a.exact is not None else a.last
    starts = b.exact if b.exact is not None else b.first
    cross = of_strings(frozenset(x + y for x, y in product(ends, starts))) if len(ends) * len(starts) <= MOST_STRINGS else ANY
    first = frozenset((x + y)[:2] for x in a.exact for y in b.first) if a.exact is not None else a.first
    last = frozenset((x + y)[-2:] for x in a.last for y in b.exact) if b.exact is not None else b.last
    x, y = a.loose(), b.loose()
    return Part(None, first, last, both(both(x.inside, y.inside), cross))


def _one_of(parts: list[Part]) -> Part:
    if all(p.exact is not None for p in parts):
        return _bounded(Part(frozenset().union(*(p.exact for p in parts))))
    loose = [p.loose() for p in parts]
    inside = loose[0].inside
    for p in loose[1:]:
        inside = either(inside, p.inside)
    return Part(None, frozenset().union(*(p.first for p in loose)), frozenset().union(*(p.last for p in loose)), inside)


def _class(items) -> Part:
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value))
        elif kind is op.RANGE and value[1] - value[0] < 4 * MOST_STRINGS:
            chars |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:  # negated, a category or wide
            return UNKNOWN
    return _bounded(Part(frozenset(c.translate(_FOLD) for c in chars)))


def _repeated(least: int, most, part: Part) -> Part:
    if (least, most) == (0, 1):
        return _one_of([EMPTY, part])
    out = EMPTY
    for _ in range(min(least, 3)):
        out = _joined(out, part)
    if least == most and least <= 3:
        return out
    # more may follow, so only the beginning and the end of the run are known
    return _joined(_joined(out, UNKNOWN), part) if least else UNKNOWN


def _walk(tree) -> Part:
    out = EMPTY
    for kind, value in tree:
        if kind is op.LITERAL:
            part = Part(frozenset([chr(value).translate(_FOLD)]))
        elif kind is op.IN:
            part = _class(value)
        elif kind is op.BRANCH:
            part = _one_of([_walk(t) for t in value[1]])
        elif kind is op.SUBPATTERN:
            part = _walk(value[3])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            part = _repeated(int(value[0]), value[1], _walk(value[2]))
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            part = EMPTY
        else:
            part = UNKNOWN
        out = _joined(out, part)
    return out


def trigram_query(pattern: str) -> Query:
    return _walk(parser.parse(pattern)).loose().inside
