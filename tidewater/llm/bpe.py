"""Byte-level BPE encoding and decoding.

Texts are cut into chunks that overlap. Chunks are pre-tokenised in parallel;
each hands the pre-token boundaries of its overlaps to its neighbours, and two
neighbours are stitched at the first boundary both have found: a match of the
pattern depends only on what follows it, so from a common boundary on, both
agree. The pieces between two stitches are then encoded by the ranks, each
alone, and the ids of a text are put together in order. Where two chunks share
no boundary (one run of letters longer than the overlap), the text is put
together again from its chunks and encoded as a whole. Most texts are one
chunk and need no stitch; they are encoded where they are read, without a
shuffle. Decoding concatenates the raw bytes of the ids.

The rank file and the pattern are parameters; the file must be readable under
the same path on every executor, as an installed package is.

Defined cases: null counts as the empty text, which has no ids; chunks of equal
long texts are encoded once; ids, order and repeats of rows don't matter; an
empty table gives an empty result; other columns stay, except one named like a
result column. Unknown ids can't be decoded and raise an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import slices, text_or_empty

CHUNK_CHARS = 32_768  # a text up to this length is one chunk
OVERLAP_CHARS = 512
LOOK_AHEAD = 3  # a match may depend on up to so many characters after its end
CACHED_PIECES = 50_000
ROWS_AT_ONCE = 128


@dataclass(frozen=True)
class ByteBpe:
    """A rank file (base64 of the token's bytes, blank, rank) and the pattern of its pre-tokens."""

    ranks_path: str
    pattern: str


class Codec:
    """Encoder and decoder of one process; a decoder alone never builds the encoder."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        self.cache: dict[str, list[int]] = {}

    def _ranks(self) -> dict[bytes, int]:
        with open(self.bpe.ranks_path, "rb") as f:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("own", pat_str=self.bpe.pattern, mergeable_ranks=self._ranks(), special_tokens={})

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(self.bpe.pattern)

    @cached_property
    def token_bytes(self) -> list[bytes | None]:
        ranks = self._ranks()
        table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        return table

    def whole(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def piece(self, piece: str) -> list[int]:
        ids = self.cache.get(piece)
        if ids is None:
            if len(self.cache) >= CACHED_PIECES:
                self.cache.clear()
            ids = self.cache[piece] = self.encoding._encode_single_piece(piece)
        return ids

    def boundaries(self, text: str, last: bool) -> list[int]:
        """Ends of the matches that more text behind ``text`` could not change."""
        end = len(text) if last else len(text) - LOOK_AHEAD
        return [e for m in self.pattern.finditer(text) if (e := m.end()) <= end]

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in ids.tolist()])


@lru_cache(maxsize=4)
def codec(bpe: ByteBpe) -> Codec:
    return Codec(bpe)


def _id_lists(lists: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _schema(df: DataFrame, *drop: str) -> T.StructType:
    """A new schema (StructType.add changes the one it is called on)."""
    return T.StructType([f for f in df.schema.fields if f.name not in drop])


IDS = T.ArrayType(T.IntegerType(), False)


def encode(docs: DataFrame, bpe: ByteBpe, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``docs`` without ``text`` and with ``token_ids`` (array of int)."""
    rows = docs.drop("token_ids").withColumn("__tw_text", text_or_empty()).drop("text")
    short = rows.filter(F.length("__tw_text") <= chunk_chars)
    long = rows.filter(F.length("__tw_text") > chunk_chars)

    def encode_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(bpe)
        for part in slices(batches, ROWS_AT_ONCE):
            k = part.schema.get_field_index("__tw_text")
            ids = [own.whole(t) for t in part.column(k).to_pylist()]
            rest = [i for i in range(part.num_columns) if i != k]
            yield _with(part.select(rest), "token_ids", _id_lists(ids))

    out = _schema(rows, "__tw_text").add(T.StructField("token_ids", IDS))
    done = short.mapInArrow(encode_short, out)

    keyed = long.withColumn("__tw_key", F.sha2("__tw_text", 256))
    ids = _encode_long(keyed.select(F.col("__tw_key").alias("key"), F.col("__tw_text").alias("text")), bpe, chunk_chars, overlap)
    joined = keyed.drop("__tw_text").join(ids.withColumnRenamed("key", "__tw_key"), "__tw_key").drop("__tw_key")
    return done.unionByName(joined.select(*[F.col(f"`{f.name}`") for f in out.fields]))


def _encode_long(texts: DataFrame, bpe: ByteBpe, chunk_chars: int, overlap: int) -> DataFrame:
    """``key`` and ``token_ids`` for each distinct text."""
    chunks = texts.withColumn("total", F.length("text")).select(
        "key", "total", F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.ceil(F.col("total") / chunk_chars).cast("int") - 1),
                lambda k: F.substring(F.col("text"), k * chunk_chars + 1, F.lit(chunk_chars + overlap)),
            )
        ).alias("k", "text"),
    )
    # a third of the rows may be copies of one long text: one copy of each chunk goes on
    chunks = chunks.groupBy("key", "k").agg(F.first("total").alias("total"), F.first("text").alias("text"))

    message = "key string, k int, kind int, text string, bounds array<int>"

    def pre_tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(bpe)
        for batch in batches:
            for row in batch.to_pylist():
                key, k, total, text = row["key"], row["k"], row["total"], row["text"]
                bounds = own.boundaries(text, k * chunk_chars + len(text) >= total)
                sent = [(key, k, 0, text, bounds)]
                if k:  # to the chunk before: from my start to the end of its overlap
                    sent.append((key, k - 1, 1, None, [0, *(b for b in bounds if b <= overlap)]))
                if (k + 1) * chunk_chars < total:  # to the next chunk, counted from its start
                    sent.append((key, k + 1, -1, None, [b - chunk_chars for b in bounds if b >= chunk_chars]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sent, strict=True), arrow.types, strict=True)], schema=arrow)

    arrow = pa.schema(
        [("key", pa.string()), ("k", pa.int32()), ("kind", pa.int32()), ("text", pa.string()), ("bounds", pa.list_(pa.int32()))]
    )
    messages = chunks.mapInArrow(pre_tokenise, message)

    def stitch(rows: pd.DataFrame) -> pd.DataFrame:
        own = codec(bpe)
        by = {r.kind: r for r in rows.itertuples(index=False)}
        me = by[0]
        mine = [0, *map(int, me.bounds)]
        start, end = 0, min(chunk_chars, len(me.text))
        synced = True
        if -1 in by:
            common = set(map(int, by[-1].bounds)).intersection(b for b in mine if b <= overlap)
            start, synced = (min(common), True) if common else (0, False)
        if 1 in by:
            common = set(map(int, by[1].bounds)).intersection(b - chunk_chars for b in mine)
            end = chunk_chars + min(common) if common else chunk_chars
        if end < start:  # the next stitch lies before mine
            synced, end = False, start
        cuts = sorted({b for b in mine if start <= b <= end} | {start, end})
        ids = [i for a, b in zip(cuts, cuts[1:], strict=False) for i in own.piece(me.text[a:b])]
        return pd.DataFrame({"key": [me.key], "k": [me.k], "synced": [synced], "ids": [np.array(ids, dtype=np.int32)]})

    spans = messages.groupBy("key", "k").applyInPandas(stitch, "key string, k int, synced boolean, ids array<int>")
    whole = spans.groupBy("key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda s: s["ids"])).alias("ids"),
        F.every("synced").alias("synced"),
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(bpe)
        for batch in batches:
            for at in range(batch.num_rows):  # long texts: one at a time
                row = batch.slice(at, 1)
                ids = row.column(1).values.slice(row.column(1).offsets[0].as_py(), len(row.column(1)[0])).to_numpy()
                if not row.column(2)[0].as_py():
                    ids = np.array(own.whole(own.decode(ids).decode("utf-8")), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([row.column(0), _id_lists([ids])], names=["key", "token_ids"])

    return whole.mapInArrow(finish, T.StructType([T.StructField("key", T.StringType()), T.StructField("token_ids", IDS)]))


def decode(rows: DataFrame, bpe: ByteBpe) -> DataFrame:
    """``rows`` with ``decoded``: the raw bytes of ``token_ids``, concatenated (null ids: null)."""
    rows = rows.drop("decoded")

    def decode_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(bpe)
        for part in slices(batches, ROWS_AT_ONCE):
            column = part.column(part.schema.get_field_index("token_ids"))
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            valid = column.is_valid().to_pylist()
            texts = [own.decode(values[a:b]) if ok else None for a, b, ok in zip(offsets, offsets[1:], valid, strict=False)]
            yield _with(part, "decoded", pa.array(texts, pa.binary()))

    return rows.mapInArrow(decode_ids, _schema(rows).add(T.StructField("decoded", T.BinaryType())))
