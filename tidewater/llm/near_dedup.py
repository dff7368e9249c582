"""Near-duplicate documents by banded MinHash, odd sketches and exact confirmation.

A document's set holds its distinct shingles of five words (of all its words, if
there are fewer). Two documents are linked when 100 times the size of the
intersection of their sets is at least 75 times that of the union.

1. Each text gives, in one pass, its set's MinHash samples, folded twice: into
   band keys, and into an odd sketch, a bitmap in which every sample flips one
   bit. The population count of the XOR of two sketches estimates how many
   samples differ, most precisely where few do.
2. Equal sets become one class, represented by its smallest id, so copies are
   never compared.
3. Documents that share a band bucket are compared by their sketches. Inside a
   bucket this is a search along allowed pairs: each document that is reached is
   held against those not reached yet, so a dense group costs little more than
   one comparison for each member, and only one row for each member leaves the
   bucket, never the pairs. Components of allowed pairs are candidate groups.
4. Texts of documents in a candidate group, and no others, are turned into full
   sets again, and the same search runs over each group, now confirming every
   step on the full sets. A group's components are those of its links.
5. Components across buckets and groups come from min-label hooking with pointer
   jumping over tables in the shared folder; the number of rounds grows with the
   logarithm of the longest chain.

Buckets and groups too large for one task are split into parts, and each pair
of parts is searched by itself.

With ``BANDS`` bands of ``ROWS`` samples a pair at the threshold misses all
buckets with probability ``(1 - 0.75 ** ROWS) ** BANDS``, about 1e-6. The
sketch lets pass what it estimates at ``SKETCH_FLOOR`` or more; a pair at the
threshold lies some five standard deviations above.

Defined cases: null or empty text, or one without words, has an empty set and
is linked with nothing; a null id has a null component, is linked with nothing
and is kept; rows that repeat an id are judged by their own texts; an empty
table gives an empty result; only the named columns are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialise, slices

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
BANDS, ROWS = 36, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
SKETCH_FLOOR = 0.5
BUCKET_ROWS = 20_000  # of one part of a bucket
GROUP_SHINGLES = 2_000_000  # of one part of a candidate group
CACHED_WORDS = 100_000

_RNG = np.random.default_rng(20_240_601)
_XOR = _RNG.integers(0, 1 << 64, SAMPLES, dtype=np.uint64)[:, None]
_MUL = _RNG.integers(0, 1 << 64, SAMPLES, dtype=np.uint64)[:, None] | np.uint64(1)
_POS = _RNG.integers(0, 1 << 64, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)
_ROW = _RNG.integers(0, 1 << 64, ROWS, dtype=np.uint64) | np.uint64(1)
_SALT = _RNG.integers(0, 1 << 64, BANDS, dtype=np.uint64)
_BIT = _RNG.integers(0, 1 << 64, SAMPLES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _WordHashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    # of bytes, lower() changes A-Z only and split() parts at blank and 0x09 to 0x0D only
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(len(h), SHINGLE_WORDS)
    n = len(h) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out += h[k : k + n] * _POS[k]
    return np.unique(_mix(out))


def samples_of(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that isn't empty."""
    low = None
    for at in range(0, len(shingles), 4096):
        part = ((shingles[at : at + 4096] ^ _XOR) * _MUL).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return low


def band_keys(samples: np.ndarray) -> np.ndarray:
    return _mix((samples.reshape(BANDS, ROWS) * _ROW).sum(axis=1, dtype=np.uint64) ^ _SALT).view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words."""
    bits = _mix(samples ^ _BIT) % np.uint64(SKETCH_BITS)
    parity = (np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


SIGNATURE = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sketch array<long>"
_SIGNATURE_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
)
ROWS_AT_ONCE = 128


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema, of) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, ROWS_AT_ONCE):
        rows = [of(i, t) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _signature(doc_id: int | None, text: str | None) -> tuple:
    shingles = shingle_set(text)
    if not len(shingles):
        return doc_id, 0, None, None, None, None
    samples = samples_of(shingles)
    return doc_id, len(shingles), *_set_key(shingles), band_keys(samples), odd_sketch(samples)


def _signature_and_text(doc_id: int | None, text: str | None) -> tuple:
    return *_signature(doc_id, text), hashlib.md5((text or "").encode(), usedforsecurity=False).hexdigest()


def text_key() -> Column:
    """Hash of a row's text, as ``near_duplicates`` returns it; null counts as empty."""
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def signatures(docs: DataFrame, by_text: bool = False) -> DataFrame:
    """One row per document: size and 128-bit key of its set, band keys, odd sketch; on request ``text_key``."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = _SIGNATURE_ARROW.append(pa.field("text_key", pa.string())) if by_text else _SIGNATURE_ARROW
    of = _signature_and_text if by_text else _signature
    return texts.mapInArrow(lambda batches: _rows(batches, schema, of), f"{SIGNATURE}, text_key string" if by_text else SIGNATURE)


# estimate >= SKETCH_FLOOR, as a bound on the bits in which two sketches differ
MOST_DIFFERING_BITS = int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - SKETCH_FLOOR) / SKETCH_BITS)))


def sketch_estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity estimated from two odd sketches."""
    differ = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
    return 1 + SKETCH_BITS / (4 * SAMPLES) * float(np.log(max(1e-9, 1 - 2 * differ / SKETCH_BITS)))


class Group:
    """Documents held against each other: ids, set sizes, sketches and, to confirm, the sets."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray] | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.sizes, self.sketches = ids[order], sizes[order], sketches[order]
        self.sets = [sets[i] for i in order] if sets else None

    def near(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` may be linked (by size and sketch), or are (with sets)."""
        own, sizes = self.sizes[one], self.sizes[others]
        near = 100 * np.minimum(own, sizes) >= THRESHOLD_PERCENT * np.maximum(own, sizes)
        near &= np.bitwise_count(self.sketches[others] ^ self.sketches[one]).sum(axis=1, dtype=np.int64) <= MOST_DIFFERING_BITS
        if self.sets is not None and near.any():
            at = np.flatnonzero(near)
            sets = [self.sets[i] for i in others[at]]
            every = np.concatenate(sets)
            mine = self.sets[one]
            inside = mine[np.minimum(np.searchsorted(mine, every), len(mine) - 1)] == every
            starts = np.cumsum([0, *(len(x) for x in sets[:-1])])
            both = np.add.reduceat(inside.astype(np.int64), starts)
            near[at] = 100 * both >= THRESHOLD_PERCENT * (own + sizes[at] - both)
        return near

    def stars(self) -> tuple[list[int], list[int]]:
        """Members and the smallest id that they reach, for those that reach a smaller one."""
        a: list[int] = []
        b: list[int] = []
        rest = np.arange(len(self.ids))
        while len(rest) > 1:
            seed, rest = rest[0], rest[1:]
            waiting = [seed]
            while waiting and len(rest):
                near = self.near(waiting.pop(), rest)
                hit, rest = rest[near], rest[~near]
                waiting.extend(hit)
                a.extend(self.ids[hit].tolist())
                b.extend([int(self.ids[seed])] * len(hit))
        return a, b


STARS = "a long, b long"
_STARS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _matrix(column: pa.ListArray) -> np.ndarray:
    # unsigned, as bits are counted of absolute values
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(column), -1)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of each group of neighbouring rows with equal (key, i, j)."""

    def stars(parts: list[tuple]) -> pa.RecordBatch | None:
        ids, sizes, sketches = (np.concatenate([p[k] for p in parts]) for k in range(3))
        sets = [x for p in parts for x in p[3]] if parts[0][3] is not None else None
        a, b = Group(ids, sizes, sketches, sets).stars()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_STARS_ARROW) if a else None

    held_key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)], axis=1)
        ids, sizes, sketches = batch.column(3).to_numpy(), batch.column(4).to_numpy(), _matrix(batch.column(5))
        sets = None
        if batch.num_columns > 6:
            flat, offsets = batch.column(6).values.to_numpy().view(np.uint64), batch.column(6).offsets.to_numpy()
            sets = [flat[x:y] for x, y in zip(offsets, offsets[1:], strict=False)]
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for x, y in zip(cuts, cuts[1:], strict=False):
            key = tuple(keys[x].tolist())
            if key != held_key:
                if held and (out := stars(held)):
                    yield out
                held_key, held = key, []
            held.append((ids[x:y], sizes[x:y], sketches[x:y], sets[x:y] if sets else None))
    if held and (out := stars(held)):
        yield out


def _in_parts(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (with ``parts``: of their group) for each pair of parts of their
    group, in groups of neighbouring rows."""
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    each = rows.withColumn("p", own).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = each.withColumns({"i": F.least("p", "q"), "j": F.greatest("p", "q")})
    return pairs.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def connected(links: DataFrame) -> DataFrame:
    """``node``, ``label`` (the smallest node reachable) for the nodes of ``links`` (a, b)."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    labels = None
    while True:
        forest = materialise(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("label")), "forest")
        while True:  # a label below its node: the chains are finite
            up = forest.select(F.col("node").alias("label"), F.col("label").alias("up"))
            jumped = forest.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label"), F.col("up").isNotNull().alias("moved"))
            forest = materialise(jumped, "forest")
            if forest.filter("moved").isEmpty():
                break
        forest = forest.select("node", "label")
        if labels is None:
            labels = forest
        else:
            moved = forest.select(F.col("node").alias("label"), F.col("label").alias("to"))
            old = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = materialise(old.unionByName(forest).groupBy("node").agg(F.min("label").alias("label")), "labels")
        edges = materialise(_relabel(edges, forest).filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def _relabel(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``edges`` with both ends replaced by their labels."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("label").alias("__tw_to"))
        edges = edges.join(own, end, "left").withColumn(end, F.coalesce("__tw_to", end)).drop("__tw_to")
    return edges


def _candidate_groups(classes: DataFrame) -> DataFrame | None:
    """``rep`` and ``cluster`` of the classes that bands and sketches allow a link."""
    banded = classes.select("rep", "n", "sketch", F.explode("bands").alias("key"))
    parts = F.ceil(F.col("rows") / BUCKET_ROWS).cast("int")
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("key", parts.alias("parts"))
    members = _in_parts(banded.join(shared, "key"), "key").select("key", "i", "j", "rep", "n", "sketch")
    allowed = materialise(members.mapInArrow(_search, STARS).distinct(), "allowed")
    if allowed.isEmpty():
        return None
    grouped = connected(allowed)
    return grouped.select(F.col("node").alias("rep"), F.col("label").alias("cluster")).unionByName(
        grouped.select(F.col("label").alias("rep"), F.col("label").alias("cluster")).distinct()
    )


def _confirmed(docs: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame | None:
    """Labels of the classes that are linked, on full sets, inside their candidate groups."""
    groups = classes.select("rep", "k1", "k2", "n", "sketch").join(groups, "rep")
    sizes = groups.groupBy("cluster").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).cast("int").alias("parts"))
    groups = materialise(groups.join(sizes, "cluster"), "groups")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string"))
    # the ids grow with the data, so this join is always a shuffle
    rows = groups.hint("merge").join(texts, "rep").select("text", "rep", "k1", "k2", "cluster", "parts", "n", "sketch")

    schema = "rep long, cluster long, parts int, n long, sketch array<long>, shingles array<long>"

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for part in slices(batches, ROWS_AT_ONCE):
            keep, sets = [], []
            own = zip(*(part.column(k).to_pylist() for k in range(4)), strict=True)
            for i, (text, rep, *key) in enumerate(own):
                if last == (rep, *key):
                    continue  # a repeated row of the same document
                shingles = shingle_set(text)
                if len(shingles) and [*_set_key(shingles)] == key:  # an id may come with several texts
                    last = (rep, *key)
                    keep.append(i)
                    sets.append(shingles.view(np.int64))
            rest = part.select(["rep", "cluster", "parts", "n", "sketch"]).take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sets, pa.list_(pa.int64()))], names=[*rest.schema.names, "shingles"])

    sets = _in_parts(rows.mapInArrow(full_sets, schema), "cluster")
    links = materialise(sets.select("cluster", "i", "j", "rep", "n", "sketch", "shingles").mapInArrow(_search, STARS).distinct(), "links")
    return None if links.isEmpty() else connected(links)


def near_duplicates(docs: DataFrame, by_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``;
    with ``by_text`` also ``text_key``, which tells rows of a repeated id apart."""
    signed = materialise(signatures(docs, by_text), "signatures")
    sets = signed.filter(F.col("k1").isNotNull() & F.col("doc_id").isNotNull())
    first = F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("m")
    classes = materialise(
        sets.groupBy("k1", "k2").agg(first).select(
            "k1", "k2", F.col("m.doc_id").alias("rep"), F.col("m.n_shingles").alias("n"), F.col("m.bands").alias("bands"), F.col("m.sketch").alias("sketch")
        ),
        "classes",
    )
    groups = _candidate_groups(classes)
    labels = _confirmed(docs, classes, groups) if groups is not None else None

    of_class = classes.select("k1", "k2", F.col("rep").alias("component"))
    if labels is not None:
        of_class = of_class.join(labels.withColumnRenamed("node", "component"), "component", "left").select("k1", "k2", F.coalesce("label", "component").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    more = ["text_key"] if by_text else []
    return (
        signed.select("doc_id", "n_shingles", "k1", "k2", *more)
        .join(of_class, ["k1", "k2"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"), *more)
    )
