"""Document fingerprints by locally consistent parsing.

A text is a sequence of symbols (code points). On each level, runs of one
symbol become one symbol; deterministic coin tossing then gives every symbol a
small label from itself and its left neighbours: twice the position of the
lowest bit in which two neighbours differ, plus that bit, repeated until labels
are below 6. Local maxima of the labels start phrases, which hold 2 to about 12
symbols; a phrase's name, a hash of its symbols, is a symbol of the next level.
A cut depends on a few symbols around it only, so a substring that two texts
share is cut alike in its interior wherever it stands.

The fingerprint begins with the text's own name, a hash of its phrases on the top
level in order, so texts that differ have different fingerprints. Then come phrase
names of the levels from ``FIRST_LEVEL`` on (phrases of about 9 characters and
more): all below ``LIMIT``, one in ``RATE``, so their number grows with the text,
but the ``KEPT`` smallest if these are more. Names are in hexadecimal, 32 bits each,
in ascending order; the text's own has 64. The same rule picks the same names in
every text, so a passage of some fifty words that two texts share, of whatever
length, shows in both, and an edit shows however long the rest is. The likeness of
two fingerprints estimates, below the bound up to which both are complete, the share
of phrases the texts have in common (Dice: twice the common ones over the sum); it
is 1 for equal texts only.

``edited_neighbours`` needs each text and the next one in the order of the ids.
Rows are range-partitioned and sorted by id, once; each task goes through its
run in one pass with one text in hand, and only the first and the last text of
each partition cross over, in a table with two rows per partition.

Defined cases: null counts as the empty text, whose fingerprint is empty; an
empty text is like another empty one (1) and unlike all others (0); null ids
come last, equal ids are ordered by text; a single row is its own neighbour; an
empty table gives an empty result; very long texts are parsed in windows that
overlap, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialise, text_or_empty

LEVELS = 6
FIRST_LEVEL = 2
KEPT = 40  # names that a short text has at least, if it has so many phrases
RATE = 20  # of a long text's names one in so many is kept
DIGITS, OWN_DIGITS = 8, 16  # hexadecimal digits of a phrase's and of a text's name
LIMIT = f"{(1 << 4 * DIGITS) // RATE:0{DIGITS}x}"
CHARS_AT_ONCE = 400_000
WINDOW, MARGIN = 1 << 20, 64

_POWERS = np.cumprod(np.full(MARGIN, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss(own, left):
    """Label of a symbol against its left neighbour (arrays of unsigned numbers)."""
    differ = own ^ left
    low = np.bitwise_count((differ & (~differ + differ.dtype.type(1))) - differ.dtype.type(1))
    low = np.where(differ == 0, 0, low).astype(np.uint8)
    return (2 * low + ((own >> low.astype(own.dtype)) & own.dtype.type(1)).astype(np.uint8)).astype(np.uint8)


_PAIRS = np.arange(128 * 128, dtype=np.uint16)
_TOSS = _toss((_PAIRS >> np.uint16(7)), (_PAIRS & np.uint16(127)))  # of labels below 128


def _starts(names: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Where phrases start (mask). ``text``: number of the text of each symbol."""
    first = np.empty(len(names), dtype=bool)
    first[0] = True
    first[1:] = text[1:] != text[:-1]
    label = np.zeros(len(names), dtype=np.uint8)
    label[1:] = _toss(names[1:], names[:-1])
    label[first] = 0
    for _ in range(3):
        low = label.astype(np.uint16)
        label[1:] = _TOSS[(low[1:] << np.uint16(7)) | low[:-1]]
        label[first] = 0
    peak = first.copy()
    last = np.append(first[1:], True)  # of its text: nothing follows
    after = np.append(label[1:], 0)
    peak[1:] |= (label[1:] > label[:-1]) & ((label[1:] > after[1:]) | last[1:])
    return peak


def _level(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and text numbers of the phrases of one level."""
    run = np.empty(len(names), dtype=bool)
    run[0] = True
    run[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(run)
    lengths = np.diff(at, append=len(names))
    names, text = names[at], text[at]
    many = lengths > 1
    names[many] = _mix(names[many] + lengths[many].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    out_names, out_text = [], []
    for a in range(0, len(names), WINDOW):
        lo, hi = max(0, a - MARGIN), min(len(names), a + WINDOW + MARGIN)
        own, of = names[lo:hi], text[lo:hi]
        peak = _starts(own, of)
        if lo:
            peak[0] = False  # only the window starts here
        starts = np.flatnonzero(peak)
        sizes = np.diff(starts, append=len(own))
        place = np.arange(starts[0], len(own)) - np.repeat(starts, sizes)
        terms = own[starts[0] :] * _POWERS[place % MARGIN]
        phrase = _mix(np.add.reduceat(terms, starts - starts[0]))
        mine = (starts + lo >= a) & (starts + lo < a + WINDOW)
        out_names.append(phrase[mine])
        out_text.append(of[starts[mine]])
    return np.concatenate(out_names), np.concatenate(out_text)


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of several texts, parsed together; each depends on its own text alone."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out = [""] * len(texts)
    if not sizes.sum():
        return out
    names = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    found_names, found_text = [], []
    for level in range(1, LEVELS + 1):
        names, text = _level(names, text)
        if level >= FIRST_LEVEL:
            found_names.append(names)
            found_text.append(text)
    # the text's own name: its top phrases in order
    firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    place = (np.arange(len(names)) - np.repeat(firsts, np.diff(firsts, append=len(names)))).astype(np.uint64)
    own = _mix(np.add.reduceat(_mix(names + place * np.uint64(0x9E3779B97F4A7C15)), firsts))
    whole = dict(zip(text[firsts].tolist(), own.tolist(), strict=True))
    names, text = np.concatenate(found_names) >> np.uint64(64 - 4 * DIGITS), np.concatenate(found_text)
    order = np.lexsort((names, text))
    names, text = names[order], text[order]
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    names, text = names[new], text[new]
    digits = names.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2 :]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    below = np.concatenate([[0], np.cumsum(names < np.uint64(int(LIMIT, 16)))])
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if i in whole:
            kept = max(KEPT, int(below[b] - below[a]))
            out[i] = f"{whole[i]:0{OWN_DIGITS}x}" + digits[a : min(b, a + kept)].tobytes().hex()
    return out


def names_of(fingerprint: str) -> tuple[list[str], str]:
    """The phrase names of a fingerprint and the bound below which none is left out."""
    names = [fingerprint[i : i + DIGITS] for i in range(OWN_DIGITS, len(fingerprint), DIGITS)]
    if len(names) < KEPT:
        return names, "g"  # above all names
    return names, max(names[KEPT - 1], LIMIT) if len(names) == KEPT else LIMIT


def likeness(a: str, b: str) -> float:
    """Estimated share of common phrases of two fingerprints' texts, 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (x, end_x), (y, end_y) = names_of(a), names_of(b)
    end = min(end_x, end_y)
    p, q = {n for n in x if n <= end}, {n for n in y if n <= end}
    total = len(p) + len(q)
    return min(2 * len(p & q) / total, 1 - 1 / (total + 1)) if total else 0.0


def edit(text: str, after: str) -> str:
    """``text`` with its last third replaced by as many first characters of ``after``, or all."""
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint`` of ``text``, without a shuffle."""

    @F.pandas_udf("string")
    def prints(text: pd.Series) -> pd.Series:
        out: list[str] = []
        batch: list[str] = []
        for t in text:
            batch.append(t)
            if sum(map(len, batch)) >= CHARS_AT_ONCE:
                out += fingerprints(batch)
                batch = []
        return pd.Series(out + fingerprints(batch), dtype=object)

    return docs.withColumn("fingerprint", prints(text_or_empty()))


RESULT = "kind int, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, text string"
_ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string()),
    ]
)
DONE, HEAD, TAIL = 0, 1, 2


def _compared(rows: list[tuple], part: int) -> list[tuple]:
    """Results of all rows (id, text, fingerprint) but the last, each against the row after it."""
    edited = [edit(a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False)]
    prints = fingerprints(edited)
    return [
        (DONE, part, a[0], len(a[1]), hashlib.sha256(e.encode()).hexdigest(), a[2], p, likeness(a[2], p), likeness(a[2], b[2]), None)
        for a, b, e, p in zip(rows, rows[1:], edited, prints, strict=False)
    ]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    packed = lambda f: None if f is None else bytes.fromhex(f)
    rows = [(*r[:5], packed(r[5]), packed(r[6]), *r[7:]) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


def _along_the_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition in order: results, and its first and last text for the neighbours."""
    part = TaskContext.get().partitionId()
    held: tuple | None = None
    waiting: list[tuple] = []

    def work() -> Iterator[pa.RecordBatch]:
        nonlocal held, waiting
        prints = fingerprints([t for _, t in waiting])
        rows = [(i, t, p) for (i, t), p in zip(waiting, prints, strict=True)]
        if held is None:
            yield _batch([(HEAD, part, rows[0][0], len(rows[0][1]), None, rows[0][2], None, None, None, rows[0][1])])
        else:
            rows.insert(0, held)
        if len(rows) > 1:
            yield _batch(_compared(rows, part))
        held, waiting = rows[-1], []

    chars = 0
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            waiting.append((ids[i].as_py(), texts[i].as_py()))
            chars += len(waiting[-1][1])
            if chars >= CHARS_AT_ONCE:
                yield from work()
                chars = 0
    if waiting:
        yield from work()
    if held:
        yield _batch([(TAIL, part, held[0], len(held[1]), None, held[2], None, None, None, held[1])])


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """For every row, in descending order of ``doc_id``: fingerprints of its
    text and of its text edited with the next row's (the last row's next is the
    first), and their likeness."""
    order = F.col("doc_id").desc_nulls_last()
    # range bounds are made on the driver from sampled keys: ids and hashes, never texts
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange(order, F.col("h")).sortWithinPartitions(order, "h").select("doc_id", "text")
    # one job: the numbers of the partitions hold for all rows of the table
    table = materialise(ordered.mapInArrow(_along_the_order, RESULT), "neighbours")
    table = table.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})

    heads = table.filter(F.col("kind") == HEAD).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    parts = heads.select(F.col("next_part").alias("part"))  # as many rows as partitions
    in_order = Window.orderBy("part")
    follow = parts.select(
        "part",
        F.coalesce(F.lead("part").over(in_order), F.first("part").over(in_order)).alias("next_part"),
    )
    tails = table.filter(F.col("kind") == TAIL).select("part", "doc_id", "n_chars", "text", "fingerprint")

    @F.pandas_udf("edited_sha256 string, edited_fingerprint string, near_edited double, near_next double")
    def compare(text: pd.Series, own: pd.Series, after: pd.Series, after_print: pd.Series) -> pd.DataFrame:
        rows = [_compared([(None, t, p), (None, n, q)], 0)[0] for t, p, n, q in zip(text, own, after, after_print, strict=True)]
        return pd.DataFrame([(r[4], r[6], r[7], r[8]) for r in rows], columns=["edited_sha256", "edited_fingerprint", "near_edited", "near_next"])

    last = (
        tails.join(follow, "part").join(heads, "next_part")
        .withColumn("c", compare("text", "fingerprint", "next_text", "next_print"))
        .select("doc_id", "n_chars", "c.edited_sha256", "fingerprint", "c.edited_fingerprint", "c.near_edited", "c.near_next")
    )
    return table.filter(F.col("kind") == DONE).select(*last.columns).unionByName(last)
