"""Query of operator 12. Tests compare with a plain search over all edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import slices, table
from tidewater.llm.registry import register
from tidewater.llm.repair import Repair, repair_conversations


def damage(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by a hash of their key."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    hurt = turns.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"),
    )
    return hurt.filter("n > 0").withColumn("n", F.explode(F.sequence(F.lit(1), "n"))).drop("n")


def text_digests(rows: DataFrame) -> DataFrame:
    """The hash of each conversation's repaired lines, taken as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first = None, True
        schema = None

        def out(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv_id": c, "repaired_sha256": h.hexdigest()} for c, h in done], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([batch.schema.field("conv_id"), ("repaired_sha256", pa.string())])
            done = []
            for part in slices(iter([batch]), 256):
                for conv, role, text in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                    line = f"{role}:{text}"
                    if first or conv != current[0]:
                        done += [] if first else [current]
                        current, first = (conv, hashlib.sha256(line.encode())), False
                    else:
                        current[1].update(b"\n" + line.encode())
            if done:
                yield out(done)
        if not first:
            yield out([current])

    ordered = rows.select("conv_id", "id", "part", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "id", "part")
    conv = rows.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {conv}, repaired_sha256 string")


def report(conversations: DataFrame, repair: Repair) -> DataFrame:
    """One row per conversation id of ``conversations``."""
    fault = F.col("fault")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = repair.turns.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.coalesce(fault == k, F.lit(False))).alias(k) for k in ("blank", "duplicate", "truncated")],
    )
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", F.translate("edits", "uaUA", "IIRR").alias("e")))), lambda b: b["e"]), "")
    edits = repair.blocks.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.min_by("cost", "block").cast("long").alias("cost"), audit.alias("audit")
    )
    out = conversations.select("conv_id").distinct()
    for more in (counts, edits, text_digests(repair.rows)):
        more = more.withColumnRenamed("conv_id", "c")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return out.na.fill(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).na.fill({"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()})


@register("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return report(conversations, repair_conversations(damage(conversations)))
