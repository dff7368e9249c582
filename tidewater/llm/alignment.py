"""Cross-tokenizer alignment by products of sparse incidence matrices.

Both tokenizers cut the same bytes, a blank and the text. With the token-byte
incidence matrices A and B in compressed sparse rows, the entry (i, j) of A.B' is
the number of bytes that token i of the first and token j of the second share, so
its non-zeros are the overlap links. The product goes row by row (Gustavson): the
rows of the right matrix that a row of the left one names are merged. Where tokens
of both end at the same byte a group ends; with the group-token incidence matrices
G and H the non-zeros of G'.H are the links of tokens that share a group.

How often an id pair is linked is counted over all documents. ``link_strengths``
writes the link matrices of documents, some at a time, as *chunks*: rows are
documents, columns the distinct id pairs of the chunk, values how often the pair is
linked in the document. A hot id pair is one entry per chunk. Pairs are counted,
joined back to the chunks that hold them, and each chunk's matrix is multiplied by
its vector of counts. Nothing is broadcast that grows with the texts, and the texts
are read and encoded once.

Long texts are encoded in parts, cut at a blank between two characters that are no
white space: there pre-tokens of the byte-level tokenizer end, and no piece of the
other one goes over it (checked when its file is loaded), so both restart there.

Defined cases: texts that are null, empty or not reproduced by the joined bytes of
both have no tokens: empty arrays, zeros and an empty hash. Rows may repeat ids or
be equal, each counts as a document; an empty table gives an empty result. ``align``
keeps other columns, except those named like a result column; ``link_strengths``
returns the columns it is told to keep and its own.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidewater.llm.common import materialise

BLANK = "▁"
PART_CHARS = 1 << 16  # texts above are encoded in parts of about this length
SLICE_CHARS = 1 << 20  # of texts worked at a time
CHUNK_LINKS = 1 << 17  # a chunk is closed at so many links

_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass(frozen=True)
class Tokenizers:
    """Files of a byte-level BPE (``tokenizers``) and a piece model (``sentencepiece``)."""

    bytes_path: str
    pieces_path: str


@dataclass(frozen=True)
class Csr:
    """Compressed sparse rows: the columns of row i are ``col[ptr[i]:ptr[i + 1]]``."""

    ptr: np.ndarray
    col: np.ndarray
    n_cols: int

    @property
    def n_rows(self) -> int:
        return len(self.ptr) - 1

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.ptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.col, kind="stable")
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.col, minlength=self.n_cols))])
        return Csr(ptr, self.row_numbers()[order], self.n_rows)


def product(left: Csr, right: Csr) -> tuple[Csr, np.ndarray]:
    """Gustavson's row products of two incidence matrices, all rows at once: the
    non-zeros and their values."""
    sizes = np.diff(right.ptr)[left.col]
    rows = np.repeat(left.row_numbers(), sizes)
    first = np.cumsum(sizes) - sizes
    cols = right.col[np.arange(len(rows)) - np.repeat(first - right.ptr[left.col], sizes)]
    keys = rows * right.n_cols + cols
    if np.any(keys[1:] < keys[:-1]):
        keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    values = np.diff(np.concatenate([new, [len(keys)]]))
    keys = keys[new]
    row_of, col_of = np.divmod(keys, max(1, right.n_cols))
    return Csr(np.searchsorted(row_of, np.arange(left.n_rows + 1)), col_of, right.n_cols), values


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens by the bytes they cover, from the tokens' ends."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(n), n)


def group_tokens(group_ends: np.ndarray, n_tokens: int) -> Csr:
    return Csr(np.concatenate([[0], group_ends]), np.arange(n_tokens), n_tokens)


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[Csr, np.ndarray]:
    return product(token_bytes(ends_a), token_bytes(ends_b).transposed())


def shared_group_links(group_a: np.ndarray, group_b: np.ndarray) -> Csr:
    """Links of all tokens that share a group, from the groups' ends in both."""
    n_a, n_b = (int(g[-1]) if len(g) else 0 for g in (group_a, group_b))
    return product(group_tokens(group_a, n_a).transposed(), group_tokens(group_b, n_b))[0]


class Codec:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, files: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(files.bytes_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.pieces_path)
        with open(files.bytes_path, encoding="utf-8") as f:
            described = json.load(f)
        vocab = described["model"]["vocab"]
        chars = byte_characters()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.a_bytes[i] = bytes(chars[c] for c in entry) if all(c in chars for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        hexed = [_BYTE.fullmatch(p) for p in pieces]
        self.b_bytes = [bytes([int(m[1], 16)]) if m else p.replace(BLANK, " ").encode() for p, m in zip(pieces, hexed, strict=True)]
        self.fast = ranked_encoding(described, self.a_bytes)
        self.a_len, self.b_len = (np.array(list(map(len, t))) for t in (self.a_bytes, self.b_bytes))
        self.n_ids = max(len(self.a_bytes), len(self.b_bytes))
        self.cuts = not any(BLANK in p.lstrip(BLANK) for p in pieces)

    def parts(self, text: str) -> list[str]:
        """``text`` cut at blanks (which go) between visible characters."""
        out, at = [], 0
        while self.cuts and len(text) - at > PART_CHARS:
            cut = _CUT.search(text, at + PART_CHARS)
            if not cut:
                break
            out.append(text[at : cut.start()])
            at = cut.end()
        return [*out, text[at:]]

    def encode(self, parts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids by both of a blank and each part; None where they don't give back its bytes."""
        found = []
        if self.fast:
            ids_a = [self.fast.encode_ordinary(f" {p}") for p in parts]
        else:
            ids_a = [e.ids for e in self.a.encode_batch_fast([f" {p}" for p in parts], add_special_tokens=False)]
        for part, a, b in zip(parts, ids_a, self.b.encode(parts, num_threads=1), strict=True):
            want = f" {part}".encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))
            found.append((a, b) if same else None)
        return found


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself
    if it can be printed, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


# Fixed value: the pre-token pattern of the byte-level scheme.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}
_PLAIN_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def ranked_encoding(described: dict, a_bytes: Sequence[bytes]) -> tiktoken.Encoding | None:
    """The same encoding by ranks, which is several times faster, where the file
    describes a plain byte-level scheme whose merges make ids in ascending order (a
    pair's rank then is its id); None where it does not."""
    model, split = described["model"], described["pre_tokenizer"] or {}
    plain = all(model.get(k) == v for k, v in _PLAIN_MODEL.items()) and all(split.get(k) == v for k, v in _PLAIN_SPLIT.items())
    if not plain or described["normalizer"]:
        return None
    made = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    special = {t["id"] for t in described["added_tokens"]}
    ranks = {data: i for i, data in enumerate(a_bytes) if i not in special}
    single = [i for data, i in ranks.items() if len(data) == 1]
    if any(p >= q for p, q in zip(made, made[1:], strict=False)) or len(single) != 256 or len(made) + 256 != len(ranks) or max(single) >= made[0]:
        return None
    return tiktoken.Encoding("byte-level", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


@lru_cache(2)
def codec(files: Tokenizers) -> Codec:
    return Codec(files)


@dataclass
class Aligned:
    """One document: ids, links by rows of the first's tokens, ends of groups."""

    a: np.ndarray
    b: np.ndarray
    link_ptr: np.ndarray
    link_b: np.ndarray
    link_bytes: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


_NONE = np.zeros(0, np.int64)
NO_TOKENS = Aligned(_NONE, _NONE, np.zeros(1, np.int64), _NONE, _NONE, _NONE, _NONE)


def _align_parts(found: list[tuple[list[int], list[int]]], c: Codec) -> list[Aligned]:
    """Parts side by side are one long text: no token and no link goes over their borders."""
    n_a, n_b = ([len(f[k]) for f in found] for k in (0, 1))
    a, b = (np.fromiter(chain.from_iterable(f[k] for f in found), np.int64, sum(n)) for k, n in ((0, n_a), (1, n_b)))
    ends_a, ends_b = np.cumsum(c.a_len[a]), np.cumsum(c.b_len[b])
    links, shared = overlap_links(ends_a, ends_b)
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    groups_a, groups_b = np.searchsorted(ends_a, common) + 1, np.searchsorted(ends_b, common) + 1
    out, at_a, at_b, at_g = [], 0, 0, 0
    for i, j in zip(np.cumsum(n_a), np.cumsum(n_b), strict=True):
        g = int(np.searchsorted(groups_a, i, side="right"))
        p = links.ptr[at_a : i + 1]
        out.append(
            Aligned(a[at_a:i], b[at_b:j], p - p[0], links.col[p[0] : p[-1]] - at_b, shared[p[0] : p[-1]], groups_a[at_g:g] - at_a, groups_b[at_g:g] - at_b)
        )
        at_a, at_b, at_g = int(i), int(j), g
    return out


def _joined(parts: list[Aligned]) -> Aligned:
    if len(parts) == 1:
        return parts[0]
    offsets = lambda sizes: np.cumsum([0, *sizes])[:-1]
    cat = lambda arrays, adds: np.concatenate([x + y for x, y in zip(arrays, adds, strict=True)])
    at_a, at_b, at_l = (offsets([len(getattr(p, n)) for p in parts]) for n in ("a", "b", "link_b"))
    whole = lambda n: np.concatenate([getattr(p, n) for p in parts])
    return Aligned(
        whole("a"), whole("b"),
        np.concatenate([[0], cat([p.link_ptr[1:] for p in parts], at_l)]),
        cat([p.link_b for p in parts], at_b), whole("link_bytes"),
        cat([p.group_a for p in parts], at_a), cat([p.group_b for p in parts], at_b),
    )


def align_texts(texts: Sequence[str | None], c: Codec) -> Iterator[Aligned]:
    """Alignments of texts, in order, about ``SLICE_CHARS`` characters at a time."""

    def some(units: list[tuple[int, str]]) -> list[tuple[int, Aligned | None]]:
        found = c.encode([p for _, p in units])
        aligned = iter(_align_parts([f for f in found if f], c))
        return [(row, next(aligned) if f else None) for (row, _), f in zip(units, found, strict=True)]

    def rows() -> Iterator[tuple[int, Aligned | None]]:
        units, size = [], 0
        for row, text in enumerate(texts):
            for part in c.parts(text) if text else [None]:
                units.append((row, part))
                size += len(part or "")
                if size >= SLICE_CHARS:
                    yield from flush(units)
                    units, size = [], 0
        yield from flush(units)

    def flush(units):
        full = iter(some([u for u in units if u[1] is not None]) if any(u[1] is not None for u in units) else [])
        return [next(full) if part is not None else (row, None) for row, part in units]

    current, parts = None, []
    for row, part in rows():
        if row != current and current is not None:
            yield NO_TOKENS if None in parts else _joined(parts)
            parts = []
        current = row
        parts.append(part)
    if current is not None:
        yield NO_TOKENS if None in parts else _joined(parts)


_ALIGN_COLUMNS = {"a_ids": "a", "b_ids": "b", "link_ptr": "link_ptr", "link_b": "link_b", "link_bytes": "link_bytes", "group_a": "group_a", "group_b": "group_b"}
_ROWS_AT_ONCE = 256


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(at, _ROWS_AT_ONCE)


def align(docs: DataFrame, files: Tokenizers) -> DataFrame:
    """``docs`` with the ids of both tokenizers (``a_ids``, ``b_ids``), the overlap
    links as compressed sparse rows (``link_ptr``, ``link_b``, bytes shared in
    ``link_bytes``) and the groups' ends in tokens (``group_a``, ``group_b``)."""
    kept = docs.select(*[c for c in docs.columns if c not in _ALIGN_COLUMNS])
    schema = StructType([*kept.schema.fields, *(StructField(n, ArrayType(IntegerType())) for n in _ALIGN_COLUMNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(files)
        for part in _slices(batches):
            done = list(align_texts(part.column("text").to_pylist(), c))
            more = [pa.array([getattr(d, n).astype(np.int32) for d in done], pa.list_(pa.int32())) for n in _ALIGN_COLUMNS.values()]
            fields = [*part.schema, *(pa.field(n, pa.list_(pa.int32())) for n in _ALIGN_COLUMNS)]
            yield pa.RecordBatch.from_arrays([*part.columns, *more], schema=pa.schema(fields))

    return kept.mapInArrow(run, schema)


@lru_cache(1)
def _written(n_ids: int) -> list[str]:
    """Each id with a comma, a bar and a semicolon behind it."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(n_ids)]


def group_hash(d: Aligned, n_ids: int) -> str:
    """SHA-256 of the ids of both in each group, ``a1,a2|b1;a3|b2,b3``; ids are below ``n_ids``."""
    if not len(d.a):
        return ""
    order = np.empty(len(d.a) + len(d.b), np.int64)
    number = np.arange(len(d.group_a))
    # a token stands behind those of both in earlier groups, and the second's behind the first's
    at_a = np.arange(len(d.a)) + np.repeat(np.concatenate([[0], d.group_b[:-1]]), np.diff(d.group_a, prepend=0))
    at_b = np.arange(len(d.b)) + d.group_a[np.repeat(number, np.diff(d.group_b, prepend=0))]
    order[at_a], order[at_b] = d.a, d.b
    order[at_a[d.group_a - 1]] += n_ids
    order[at_b[d.group_b - 1]] += 2 * n_ids
    text = "".join(map(_written(n_ids).__getitem__, order.tolist()))
    return hashlib.sha256(text[:-1].encode()).hexdigest()


_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


def _chunk(number: int, rows: list[dict], docs: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    """A chunk's matrix: documents by distinct id pairs."""
    sizes = list(map(len, docs))
    pairs, at = np.unique(np.concatenate(docs), return_inverse=True)
    entries, times = np.unique(np.repeat(np.arange(len(docs)), sizes) * max(1, len(pairs)) + at, return_counts=True)
    doc_of, pair_of = np.divmod(entries, max(1, len(pairs)))
    ptr = np.searchsorted(doc_of, np.arange(len(docs) + 1))
    held = np.bincount(pair_of, minlength=len(pairs))
    values = [[number], [rows], [ptr.astype(np.int32)], [pair_of.astype(np.int32)], [times.astype(np.int32)], [pairs], [held.astype(np.int32)]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def link_chunks(docs: DataFrame, files: Tokenizers, keep: Sequence[str]) -> DataFrame:
    """The link matrices of all documents, written: ``rows`` (kept columns, counts,
    group hash), ``ptr``, ``pair_at``, ``times``, and the chunk's ``pairs`` with the
    number of its documents that hold each (``held``)."""
    own = [*(StructField(n, LongType()) for n in _COUNTS), StructField("groups_sha256", StringType())]
    row = StructType([*(docs.schema[c] for c in keep), *own])
    ints = ArrayType(IntegerType())
    schema = StructType(
        [StructField("chunk", LongType()), StructField("rows", ArrayType(row)), *(StructField(n, ints) for n in ("ptr", "pair_at", "times")),
         StructField("pairs", ArrayType(LongType())), StructField("held", ints)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, arrow = codec(files), None
        number = TaskContext.get().partitionId() << 32
        rows, pairs, links = [], [], 0
        for part in _slices(batches):
            if arrow is None:
                fields = [*(part.schema.field(k) for k in keep), *(pa.field(n, pa.int64()) for n in _COUNTS), pa.field("groups_sha256", pa.string())]
                arrow = pa.schema([("chunk", pa.int64()), ("rows", pa.list_(pa.struct(fields))), ("ptr", _INTS), ("pair_at", _INTS), ("times", _INTS), ("pairs", _LONGS), ("held", _INTS)])
            names = part.select(list(keep)).to_pylist()
            for name, d in zip(names, align_texts(part.column("text").to_pylist(), c), strict=True):
                shared = int(np.sum(np.diff(d.group_a, prepend=0) * np.diff(d.group_b, prepend=0)))
                counts = (len(d.a), len(d.b), len(d.group_a), len(d.link_b), shared)
                rows.append(name | dict(zip(_COUNTS, counts, strict=True)) | {"groups_sha256": group_hash(d, c.n_ids)})
                pairs.append(np.repeat(d.a, np.diff(d.link_ptr)) << 32 | d.b[d.link_b])
                links += len(d.link_b)
                if links >= CHUNK_LINKS:
                    yield _chunk(number, rows, pairs, arrow)
                    rows, pairs, links, number = [], [], 0, number + 1
        if rows:
            yield _chunk(number, rows, pairs, arrow)

    return materialise(docs.select(*keep, "text").mapInArrow(run, schema), "link-chunks")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair`` (first id shifted by 32 bits, second id), ``n`` (documents that hold
    it linked) and ``best`` (1 if no pair of its first id has more)."""
    held = chunks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("p.pairs", "p.held")
    counts = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n"))
    counts = materialise(counts.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))


def link_strengths(docs: DataFrame, files: Tokenizers, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per document the kept columns, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_shared`` (links of tokens in one group), ``groups_sha256``, ``n_best`` (links
    whose pair is its first id's most frequent) and ``count_sum`` (documents that
    hold a link's pair, summed over links)."""
    chunks = link_chunks(docs, files, keep)
    asked = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    vectors = (
        asked.join(pair_counts(chunks), "pair").groupBy("chunk").agg(F.collect_list(F.struct("at", "n", "best")).alias("vector"))
    )
    rows = chunks.schema["rows"].dataType.elementType
    schema = StructType([*rows.fields, StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                table = one.column("rows").flatten()
                ptr, at, times = (one.column(c).flatten().to_numpy() for c in ("ptr", "pair_at", "times"))
                given = one.column("vector").flatten()
                where, n, best = (given.field(f).to_numpy(zero_copy_only=False) for f in ("at", "n", "best")) if len(given) else (_NONE,) * 3
                out = []
                for values in (best, n):
                    vector = np.zeros(len(where), np.int64)
                    vector[where] = values
                    sums = np.concatenate([[0], np.cumsum(times * vector[at])])
                    out.append(pa.array(sums[ptr[1:]] - sums[ptr[:-1]]))
                names = [f.name for f in table.type]
                yield pa.RecordBatch.from_arrays([*table.flatten(), *out], names=[*names, "n_best", "count_sum"])

    return chunks.select("chunk", "rows", "ptr", "pair_at", "times").join(vectors, "chunk", "left").mapInArrow(run, schema)
