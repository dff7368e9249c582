"""K9: a table with one row per key, upserted by snapshots.

Layout below the table's folder::

    data/<folder>/part=<p>/...parquet   a folder per commit, with the parts it wrote
    versions/<n>                        a manifest: for each part its folder and rows

A manifest names the whole snapshot, and commits by one rename (``manifest``). An
upsert reads and rewrites only the parts that hold an updated key; the new manifest
points to their new folders and to the old ones of all other parts. A writer that
dies before the rename leaves files that no manifest names: readers keep seeing the
last whole version. Two writers of one version: the second fails and may try again.

Parts follow the size by linear hashing. With ``n`` parts, ``m`` the greatest power of
two not above ``n``, a key's part is ``hash mod 2m``, less ``m`` where that is not below
``n``. Part ``n`` comes into being by splitting part ``n - m``, so growing by one part
rewrites one part. The rows of the last snapshot decide how many parts there should
be (``rows_per_part`` each); an upsert comes as near to that as it can by splitting at
most as many parts as it touches, so its work stays in proportion to the update, and
a table made with too few parts grows into its size step by step.

The manifest is metadata: a few numbers per part, handled by the driver, like a
listing of folders. Rows never are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewater.operators.aggregates import keep_latest
from tidewater.session import parallelism, shared_path
from tidewater.sinks.manifest import commit_text, names_in, read_text, remove

ROWS_PER_PART = 4_000_000  # about 1 GB of Parquet at 250 bytes a row
PART = "__part"
SLOT = "__slot"


def part_of(keys: Sequence[str], parts: int) -> Column:
    """The part of a key among ``parts``, by linear hashing."""
    low = 1 << (parts.bit_length() - 1)
    place = F.pmod(F.xxhash64(*keys), F.lit(2 * low))
    return F.when(place < parts, place).otherwise(place - low).cast("int")


def _slot(parts: int, touched: set[int]) -> Column:
    """The place of a part among the ``touched`` ones; of all, if none is named."""
    if not touched:
        return F.col(PART)
    place = {p: k for k, p in enumerate(sorted(touched))}
    # a constant to Spark, made of one string as there may be thousands of parts
    places = F.split(F.lit(",".join(str(place.get(p, 0)) for p in range(parts))), ",").cast("array<int>")
    return F.get(places, F.col(PART))


def split_sources(old: int, new: int) -> set[int]:
    """The parts among ``old`` whose keys may move when there are ``new``."""
    sources = set()
    for made in range(old, new):
        source = made
        while source >= old:
            source -= 1 << (source.bit_length() - 1)
        sources.add(source)
    return sources


@dataclass(frozen=True)
class Snapshot:
    version: int
    parts: int
    folders: dict[int, str]  # of the parts that hold rows
    rows: dict[int, int]

    @property
    def row_count(self) -> int:
        return sum(self.rows.values())

    def after(self, parts: int, rewritten: set[int], folder: str, rows: dict[int, int]) -> Snapshot:
        """The next version: ``rewritten`` parts have the given rows in ``folder``."""
        kept = {p: f for p, f in self.folders.items() if p not in rewritten}
        counts = {p: n for p, n in self.rows.items() if p not in rewritten}
        return Snapshot(self.version + 1, parts, kept | {p: folder for p in rows}, counts | rows)


class KeyedTable:
    """Rows are unique by ``keys``; of several the greatest by ``order`` (nulls
    first) is the row. Columns keep the names and types of the first rows."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], rows_per_part: int = ROWS_PER_PART):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.rows_per_part = list(keys), list(order), rows_per_part

    @classmethod
    def create(
        cls,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        name: str = "keyed",
        parts: int | None = None,
        unique: bool = False,
        rows_per_part: int = ROWS_PER_PART,
    ) -> KeyedTable:
        """A new table. ``unique``: the caller states that no key repeats, so nothing
        is compared. Starts with as many parts as the session shuffles into."""
        spark = rows.sparkSession
        table = cls(spark, shared_path(spark, "tables", name), rows.schema, keys, order, rows_per_part)
        parts = parts or parallelism(spark)
        latest = rows if unique else keep_latest(rows, table.keys, table.order).select(*rows.columns)
        table._commit(Snapshot(-1, parts, {}, {}), parts, set(), latest)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        found = json.loads(read_text(spark, f"{path.rstrip('/')}/versions/{cls._latest(spark, path)}"))
        return cls(spark, path, StructType.fromJson(found["schema"]), found["keys"], found["order"], found["rows_per_part"])

    @staticmethod
    def _latest(spark: SparkSession, path: str) -> str:
        versions = [n for n in names_in(spark, f"{path.rstrip('/')}/versions") if n.isdigit()]
        if not versions:
            raise FileNotFoundError(f"no committed version below {path}")
        return versions[-1]

    def versions(self) -> list[int]:
        return [int(n) for n in names_in(self.spark, f"{self.path}/versions") if n.isdigit()]

    def snapshot(self, version: int | None = None) -> Snapshot:
        name = self._latest(self.spark, self.path) if version is None else f"{version:012d}"
        found = json.loads(read_text(self.spark, f"{self.path}/versions/{name}"))
        folders = {p: found["folders"][f] for p, f, _ in found["parts"]}
        return Snapshot(found["version"], found["n_parts"], folders, {p: n for p, _, n in found["parts"]})

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a snapshot, by default of the last one."""
        return self._rows(self.snapshot(version))

    def _rows(self, snapshot: Snapshot, parts: set[int] | None = None) -> DataFrame:
        folders = [f"{self.path}/data/{f}/{PART}={p}" for p, f in sorted(snapshot.folders.items()) if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def upsert(self, updates: DataFrame) -> Snapshot:
        """``updates`` into the table; returns the new snapshot. They are evaluated
        once, and compared among themselves before they meet the table."""
        before = self.snapshot()
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        latest = keep_latest(updates.select(*self.schema.names), self.keys, self.order)
        latest.withColumn(PART, part_of(self.keys, before.parts)).write.parquet(staged)
        changed = self.spark.read.parquet(staged)
        # one number per touched part
        touched = {r[0] for r in changed.select(PART).distinct().collect()}
        if not touched:
            remove(self.spark, staged)
            return before
        # as many parts as the rows need, but no more new ones than this upsert rewrites anyway
        wanted = -(-before.row_count // self.rows_per_part)
        parts = max(before.parts, min(wanted, before.parts + len(touched)))
        touched |= split_sources(before.parts, parts)
        merged = self._rows(before, touched).unionByName(changed.select(*self.schema.names))
        after = self._commit(before, parts, touched, merged, compare=True)
        remove(self.spark, staged)
        return after

    def _commit(self, before: Snapshot, parts: int, touched: set[int], rows: DataFrame, compare: bool = False) -> Snapshot:
        """Writes ``rows``, all rows of the touched parts, and commits the snapshot.
        One shuffle by part serves the comparison by key and the write."""
        folder = f"{before.version + 1:012d}-{uuid.uuid4().hex[:12]}"
        # a task for each part that is written
        placed = rows.withColumn(PART, part_of(self.keys, parts)).withColumn(SLOT, _slot(parts, touched))
        placed = placed.repartitionById(len(touched) or parts, SLOT)
        if compare:
            placed = keep_latest(placed, [SLOT, *self.keys], self.order)
        path = f"{self.path}/data/{folder}"
        placed.select(*self.schema.names, PART).write.partitionBy(PART).parquet(path)
        written = self.spark.read.schema(StructType([*self.schema.fields, StructField(PART, IntegerType())])).parquet(path)
        counts = {r[0]: r[1] for r in written.groupBy(PART).count().collect()}
        after = before.after(parts, touched | set(counts), folder, counts)
        self._write_manifest(after)
        return after

    def _write_manifest(self, s: Snapshot) -> None:
        folders = sorted(set(s.folders.values()))
        number = {f: k for k, f in enumerate(folders)}
        text = json.dumps(
            {
                "version": s.version, "n_parts": s.parts, "keys": self.keys, "order": self.order, "rows_per_part": self.rows_per_part,
                "schema": self.schema.jsonValue(), "folders": folders, "parts": [[p, number[f], s.rows[p]] for p, f in sorted(s.folders.items())],
            }
        )
        commit_text(self.spark, f"{self.path}/versions/{s.version:012d}", text)

    def expire(self, keep: int = 1) -> list[str]:
        """Forgets all but the last ``keep`` versions and removes the part folders
        that none of these names; run it while no upsert is under way."""
        versions = self.versions()
        for old in versions[:-keep]:
            remove(self.spark, f"{self.path}/versions/{old:012d}")
        named = {(f, p) for v in versions[-keep:] for p, f in self.snapshot(v).folders.items()}
        gone = []
        for folder in names_in(self.spark, f"{self.path}/data"):
            for entry in names_in(self.spark, f"{self.path}/data/{folder}"):
                if entry.startswith(f"{PART}=") and (folder, int(entry.partition("=")[2])) not in named:
                    remove(self.spark, f"{self.path}/data/{folder}/{entry}")
                    gone.append(f"{folder}/{entry}")
        return gone


def keyed_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "upsert") -> DataFrame:
    """K9: ``target`` as a keyed table, ``updates`` into it, the table read back.

    Stands in for an append into a keyed store (where a later write for the
    same primary key replaces the row).
    """
    table = KeyedTable.create(target, keys, order, name)
    table.upsert(updates)
    return table.read()
