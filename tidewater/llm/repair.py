"""Conversation structure repair: the cheapest edits that make turns alternate.

Turns of a conversation are taken by ``turn`` (nulls first; rows of one turn by a
hash of role and text, so equal rows are neighbours). A turn's first fault counts:
blank (nothing but white space), duplicate (its role and text came earlier),
truncated (its last visible character is none of ``.!?``). Edits: keep (0), change
the role to user or assistant (2), delete (3; a must for blank and duplicate),
insert an empty user's or assistant's turn anywhere (2); a truncated turn that
stays costs 1. What remains must read ``(s?(ua)+)?`` in role initials. Of the
cheapest edits those whose initials (D, I, K, R) are least in ASCII order are taken.

The dynamic program is checkpointed twice. Positions are numbered globally by one
range shuffle of keys (no texts), which cuts a hot conversation like any other, and
``1 << BLOCK_BITS`` positions make a block. Per block, in parallel: the (min, +)
product of its turns, four by four costs. Per conversation, as a stream over its
blocks from the last to the first: the backward cost vector at every block's end,
the checkpoint. Per block again: the walks forward from all four states
(``repair_walk.walks``, which recomputes between checkpoints of its own), and as a
stream from the first block to the last the walk that holds. So no task holds more
than a block of codes, however long a conversation is; the streams see one row a
block. Texts are shuffled once, when the edits are applied.

Defined cases: null roles and texts are one space, an empty role has no initial
that could stay; null conversation ids are one conversation; equal rows are turns
of their own, duplicates of the first; an empty table gives empty results. All
results have their own columns only; other input columns are dropped. Role and
text are compared by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidewater.llm.common import array_slices, materialise
from tidewater.llm.repair_walk import END, cached_transfer, cached_walks, tail, through

BLOCK_BITS = 12
WHITE = " \t\n\x0b\f\r"
_NO_TURN = -(1 << 63)


@dataclass(frozen=True)
class Repair:
    """``turns``: conv_id, turn, id (position), said (hash of role and text),
    initial, fault. ``blocks``: conv_id, block, first_id, edits, cost (of the
    conversation from this block on), illegal (adjacent roles that may not be
    neighbours). ``rows``: the repaired turns, conv_id, id, part, role, text, edit."""

    turns: DataFrame
    blocks: DataFrame
    rows: DataFrame


def _clean(turns: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_NO_TURN)).alias("at"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("said"),
    )


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def number_turns(clean: DataFrame) -> DataFrame:
    """Every turn with its position and fault, written without its text."""
    visible = F.rtrim("text", F.lit(WHITE))
    keys = clean.select(
        "conv_id", "turn", "at", "said", _initial(F.col("role")).alias("initial"),
        (visible == "").alias("blank"), (~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    # equal rows are counted before the shuffle
    counted = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    again = keys.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("h")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    again = again.filter("first < last").drop("last")
    joined = counted.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("h")), "left").drop("c", "h")
    order = ["conv_id", "at", "said"]
    copies = joined.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    fault = (
        F.when(F.col("blank"), "blank")
        .when((F.col("copy") > 1) | F.coalesce(F.col("at") > F.col("first"), F.lit(False)), "duplicate")
        .when(F.col("cut"), "truncated")
    )
    # ids follow the order of the range partitions; once written they stay
    numbered = copies.select("conv_id", "turn", "at", "said", "initial", fault.alias("fault"), F.monotonically_increasing_id().alias("id"))
    return materialise(numbered, "repair-turns")


def _stream(blocks: DataFrame, order: list[Column], walk, more: list[StructField]) -> DataFrame:
    """Rows of ``blocks`` by conversation in ``order`` through ``walk(new, row, state)``,
    which returns the values of the columns ``more`` and the next state; ``last``
    is true for a conversation's last row of that order."""
    kept = blocks.schema.fields
    schema = StructType([*kept, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None  # one row is held back, to know whether it is the last one

        def values(row: dict, last: bool):
            nonlocal state
            out, state = walk(row, state, last)
            return row | out

        arrow = None
        for batch in batches:
            if arrow is None:
                arrow = pa.schema([*batch.schema, *(pa.field(f.name, pa.string() if isinstance(f.dataType, StringType) else pa.list_(pa.int32()) if isinstance(f.dataType, ArrayType) else pa.int32()) for f in more)])
            done = []
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if held is not None:
                        last = held["conv_id"] != row["conv_id"]
                        done.append(values(held, last))
                        state = None if last else state
                    held = row
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
        if held is not None:
            yield pa.RecordBatch.from_pylist([values(held, True)], schema=arrow)

    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, schema)


@F.arrow_udf(ArrayType(IntegerType()))
def _transfers(codes: pa.Array) -> pa.Array:
    return pa.array([cached_transfer(bytes(c)) for part in array_slices(codes) for c in part], pa.list_(pa.int32()))


@F.arrow_udf(ArrayType(StructType([StructField("edits", StringType()), StructField("state", IntegerType())])))
def _walks(codes: pa.Array, ends: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("edits", pa.string()), ("state", pa.int32())]))
    out = []
    for some, after in zip(array_slices(codes), array_slices(ends), strict=True):
        out += [[{"edits": e, "state": s} for e, s in cached_walks(bytes(c), tuple(v))] for c, v in zip(some, after, strict=True)]
    return pa.array(out, kind)


def _backward(row: dict, state, last: bool):
    v = END if state is None else state
    start = through(row["matrix"], v)
    return {"end": list(v), "cost": start[0]}, start


def _forward(row: dict, state, last: bool):
    at, before = (0, None) if state is None else state
    walk = row["walks"][at]
    edits = walk["edits"] + (tail(walk["state"]) if last else "")
    between = 0 if before is None else int((before, row["initials"][0]) not in LEGAL)
    return {"edits": edits, "between": between}, (walk["state"], row["initials"][1])


LEGAL = {(0, 1), (1, 2), (2, 1)}  # neighbouring initials


def find_edits(turns: DataFrame) -> DataFrame:
    """One row per conversation and block, written."""
    code = F.col("initial") * 3 + F.when(F.col("fault").isin("blank", "duplicate"), 1).when(F.col("fault") == "truncated", 2).otherwise(0)
    listed = turns.groupBy("conv_id", F.shiftright("id", BLOCK_BITS).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("id", code.alias("code"), "initial"))).alias("t")
    )
    legal = lambda p, q: ((p == 0) & (q == 1)) | ((p == 1) & (q == 2)) | ((p == 2) & (q == 1))
    pairs = F.zip_with(F.expr("slice(t.initial, 1, size(t) - 1)"), F.expr("slice(t.initial, 2, size(t) - 1)"), legal)
    blocks = listed.select(
        "conv_id", "block",
        F.col("t")[0]["id"].alias("first_id"),
        F.array(F.col("t")[0]["initial"], F.element_at("t", -1)["initial"]).alias("initials"),
        F.size(F.filter(pairs, lambda ok: ~ok)).alias("inside"),
        F.col("t.code").alias("codes"),
    ).withColumn("matrix", _transfers("codes"))
    ints = ArrayType(IntegerType())
    back = _stream(blocks, [F.desc("block")], _backward, [StructField("end", ints), StructField("cost", IntegerType())])
    # dealt out again, so that the blocks of a long conversation are walked in parallel
    walked = back.drop("matrix").repartition("conv_id", "block").withColumn("walks", _walks("codes", "end")).drop("codes", "end")
    chained = _stream(walked, [F.asc("block")], _forward, [StructField("edits", StringType()), StructField("between", IntegerType())])
    return materialise(chained.select("conv_id", "block", "first_id", "edits", "cost", (F.col("inside") + F.col("between")).alias("illegal")), "repair-blocks")


def apply_edits(clean: DataFrame, turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """The repaired turns: ``id`` and ``part`` order the rows of a conversation."""
    edits = blocks.select("first_id", F.posexplode(F.regexp_extract_all("edits", F.lit("[ua]*[KDUA](?:[ua]+$)?"), F.lit(0))).alias("k", "edit"))
    edits = edits.select((F.col("first_id") + F.col("k")).alias("id"), "edit")
    said = turns.select(F.col("conv_id").alias("c"), F.col("at").alias("a"), F.col("said").alias("h"), "id").join(edits, "id")
    texts = clean.select("conv_id", "at", "said", "role", "text").dropDuplicates(["conv_id", "at", "said"])
    same = texts["conv_id"].eqNullSafe(F.col("c")) & (texts["at"] == F.col("a")) & (texts["said"] == F.col("h"))
    chars = F.split("edit", "")
    return (
        said.join(texts, same)
        .select("conv_id", "id", "role", "text", F.posexplode(F.filter(chars, lambda e: ~e.isin("", "D"))).alias("part", "edit"))
        .select(
            "conv_id", "id", "part",
            F.when(F.col("edit").isin("u", "U"), "user").when(F.col("edit").isin("a", "A"), "assistant").otherwise(F.col("role")).alias("role"),
            F.when(F.col("edit").isin("u", "a"), "").otherwise(F.col("text")).alias("text"),
            "edit",
        )
    )


def repair_conversations(turns: DataFrame) -> Repair:
    """Repairs conversations (``conv_id``, ``turn``, ``role``, ``text``)."""
    clean = _clean(turns)
    numbered = number_turns(clean)
    blocks = find_edits(numbered)
    return Repair(numbered, blocks, apply_edits(clean, numbered, blocks))
