"""Chat formatting in budgeted windows.

A turn is formatted as ``<|im_start|>role``, a line feed, the text and
``<|im_end|>``, a line feed. Inside roles and texts every ``<``, backslashes,
``|`` gets one more backslash, so no text holds a control string, and reading
back removes it again; line feeds and percent signs of roles are
percent-encoded.

A conversation is cut into windows of whole turns. Running sums of the turns'
token counts choose each window's last turn: the largest one that keeps the
window within ``BUDGET`` tokens. A window starts with the system turn, if the
conversation starts with one, and with the last turns before it, up to
``HISTORY`` tokens; both are repeats. Only the texts of assistant turns that a
window does not repeat are targets, so each is a target once. A turn that is
longer than the budget has a window of its own, without history.

Turns are escaped and their tokens counted where they are read. One shuffle by
conversation and a sort that spills then bring the turns in order; a task goes
through its rows once and holds one window, so a conversation of any length
needs little memory. (The windows of one conversation depend on each other in
order, so they are made by one task, from the counts.)

Defined cases: null text or role is empty; null conversation ids are one
conversation; turns with equal numbers are ordered by role and text, repeated
rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.bpe import ByteBpe, codec
from tidewater.llm.common import array_slices

BUDGET = 1024
HISTORY = 256
WINDOWS_AT_ONCE = 256

START, END = "<|im_start|>", "<|im_end|>\n"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


@dataclass
class Turn:
    role: str
    text: str  # escaped
    tokens: int
    upto: int  # running sum of tokens, this turn included

    @property
    def formatted(self) -> str:
        return f"{START}{escape_role(self.role)}\n{self.text}{END}"


@dataclass
class Conversation:
    """Turns of one conversation as they come, and the windows they fill."""

    conv_id: int | None
    budget: int
    history_limit: int
    system: Turn | None = None
    history: list[Turn] = field(default_factory=list)
    turns: list[Turn] = field(default_factory=list)
    upto: int = 0
    seen: int = 0
    windows: int = 0

    def add(self, role: str, text: str, tokens: int) -> tuple | None:
        """Takes a turn; the window that it closes, if any."""
        self.upto += tokens
        turn = Turn(role, text, tokens, self.upto)
        done = None
        if self.turns:
            first = (self.history or self.turns)[0]
            used = self.upto - (first.upto - first.tokens)
            if self.windows and self.system:
                used += self.system.tokens
            if used > self.budget:
                done = self.close()
                self._history(tokens)
        if self.seen == 0 and role == "system":
            self.system = turn
        self.turns.append(turn)
        self.seen += 1
        return done

    def _history(self, tokens: int) -> None:
        """The last turns that fit the limit and, with the next turn, the budget."""
        before = [t for t in self.history + self.turns if t is not self.system]
        room = min(self.history_limit, self.budget - tokens - (self.system.tokens if self.system else 0))
        end = self.turns[-1].upto
        self.history = [t for t in before if end - (t.upto - t.tokens) <= room]
        self.turns = []

    def close(self) -> tuple:
        repeated = ([self.system] if self.system and self.windows else []) + self.history
        text, spans = "", []
        for k, turn in enumerate(repeated + self.turns):
            if k >= len(repeated) and turn.role == "assistant":
                start = len(text) + len(START) + len(escape_role(turn.role)) + 1
                spans.append({"start": start, "end": start + len(turn.text)})
            text += turn.formatted
        tokens = sum(t.tokens for t in repeated + self.turns)
        out = (self.conv_id, self.windows, len(repeated), len(self.turns), tokens, text, spans)
        self.windows += 1
        return out


WINDOWS = (
    "conv_id long, window int, n_repeated int, n_new int, n_tokens int, formatted string, loss_spans array<struct<start:int,end:int>>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("window", pa.int32()), ("n_repeated", pa.int32()), ("n_new", pa.int32()), ("n_tokens", pa.int32()), ("formatted", pa.string()), ("loss_spans", _SPANS)]
)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def format_conversations(turns: DataFrame, bpe: ByteBpe, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of all conversations (``conv_id``, ``turn``, ``role``, ``text``).
    Rows of one conversation are neighbours in one partition, in order."""

    @F.arrow_udf("safe string, tokens int")
    def counted(role: pa.Array, text: pa.Array) -> pa.Array:
        """The escaped text, or null if that is the text itself, and the tokens of the formatted turn."""
        count = codec(bpe).whole
        out = []
        for r, t in zip(array_slices(role), array_slices(text), strict=True):
            for said_by, said in zip(r, t, strict=True):
                safe = escape(said)
                out.append({"safe": None if safe == said else safe, "tokens": len(count(f"{START}{escape_role(said_by)}\n{safe}{END}"))})
        return pa.array(out, pa.struct([("safe", pa.string()), ("tokens", pa.int32())]))

    ordered = (
        turns.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("c", counted("role", "text"))
        .select("conv_id", "turn", "role", "text", "c.safe", "c.tokens")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", F.coalesce("safe", "text").alias("text"), "tokens")
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Conversation | None = None
        done: list[tuple] = []
        for batch in batches:
            for conv_id, role, safe, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or conv_id != current.conv_id:
                    if current:
                        done.append(current.close())
                    current = Conversation(conv_id, budget, history)
                window = current.add(role, safe, tokens)
                if window:
                    done.append(window)
                if len(done) >= WINDOWS_AT_ONCE:
                    yield _batch(done, _ARROW)
                    done = []
        if current:
            done.append(current.close())
        if done:
            yield _batch(done, _ARROW)

    return ordered.mapInArrow(windows, WINDOWS)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def read_back(windows: DataFrame) -> DataFrame:
    """Counts and hashes of every conversation, from its windows alone (in the
    order that ``format_conversations`` returns them)."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        done: list[tuple] = []

        def finish() -> tuple:
            conv_id, n, turns, chars, loss, formatted = current
            return conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), formatted

        for batch in batches:
            for row in batch.to_pylist():
                if current is None or row["window"] == 0:
                    if current:
                        done.append(finish())
                    current = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                for role, said in read_turns(text)[row["n_repeated"] :]:
                    current[1] += 1
                    current[2].update(f"{role}\n{said}\n".encode())
                for span in row["loss_spans"]:
                    target = unescape(text[span["start"] : span["end"]])
                    current[3] += len(target)
                    current[4].update(target.encode())
                current[5] += len(text)
            if done:
                yield _batch(done, _DIGESTS)
                done = []
        if current:
            yield _batch([finish()], _DIGESTS)

    return windows.mapInArrow(digests, DIGESTS)
