"""A table whose partitioning changes, with an index of its files.

Layout below the table's folder::

    data/<commit>/[<p_column>=<value>/...]part-*.parquet
    index/<commit>/...parquet   a row per data file: path, spec, rows, least and
                                greatest value and number of nulls of the indexed columns
    versions/<n>                a manifest: the specs so far and the commits (``manifest``)

``evolve`` changes the partition columns of what is written from then on; nothing is
rewritten, old files keep their layout. A scan with ranges first asks the index, a
small table that Spark filters like any other, for the files whose least and greatest
values meet the ranges, whatever layout they were written in, and then reads these
files only (and filters their rows). Partition columns stay in the files (the folders
are named ``p_<column>``), so files of all layouts have the same columns.

Rows of a commit without partition columns are range-clustered by ``cluster_by`` into
as many files as the session shuffles into, so a file holds a narrow range and the index can skip it; with partition columns there
is a folder per value, and a value too large for one task gets several files.

The driver holds the paths of the files a scan reads, as every file scan does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewater.session import parallelism, shared_path
from tidewater.sinks.manifest import commit_text, names_in, read_text

Range = tuple[Any, Any]  # least and greatest value that is asked for, None for no bound


def file_path() -> Column:
    """The path of a row's file as readers take it (the metadata column is a URI)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def literal(value: Any, like: str) -> Column:
    return F.lit(value).cast(like)


class EvolvingTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, cluster_by: Sequence[str], indexed: Sequence[str]):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.cluster_by, self.indexed = list(cluster_by), list(indexed)

    @classmethod
    def create(
        cls, rows: DataFrame, indexed: Sequence[str], cluster_by: Sequence[str] = (), partition_by: Sequence[str] = (), name: str = "evolving"
    ) -> EvolvingTable:
        spark = rows.sparkSession
        table = cls(spark, shared_path(spark, "tables", name), rows.schema, cluster_by, indexed)
        table._commit({"version": -1, "specs": [list(partition_by)], "commits": []}, rows)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> EvolvingTable:
        found = cls(spark, path, StructType(), (), ())._state()
        return cls(spark, path, StructType.fromJson(found["schema"]), found["cluster_by"], found["indexed"])

    def _state(self, version: int | None = None) -> dict:
        names = [n for n in names_in(self.spark, f"{self.path}/versions") if n.isdigit()]
        name = names[-1] if version is None else f"{version:012d}"
        return json.loads(read_text(self.spark, f"{self.path}/versions/{name}"))

    @property
    def specs(self) -> list[list[str]]:
        return self._state()["specs"]

    def evolve(self, partition_by: Sequence[str]) -> None:
        """Rows written from now on are partitioned by these columns. No data moves."""
        state = self._state()
        self._save(state | {"version": state["version"] + 1, "specs": [*state["specs"], list(partition_by)]})

    def append(self, rows: DataFrame) -> None:
        self._commit(self._state(), rows.select(*self.schema.names))

    def _commit(self, state: dict, rows: DataFrame) -> None:
        commit = f"{state['version'] + 1:012d}-{uuid.uuid4().hex[:12]}"
        data, spec = f"{self.path}/data/{commit}", len(state["specs"]) - 1
        folders = [f"p_{c}" for c in state["specs"][spec]]
        if folders:
            keyed = rows.withColumns({f"p_{c}": F.col(c) for c in state["specs"][spec]})
            keyed.hint("rebalance", *folders).write.partitionBy(*folders).parquet(data)
        elif self.cluster_by:
            rows.repartitionByRange(parallelism(self.spark), *self.cluster_by).sortWithinPartitions(*self.cluster_by).write.parquet(data)
        else:
            rows.write.parquet(data)
        self._index(data, spec).write.parquet(f"{self.path}/index/{commit}")
        self._save(state | {"version": state["version"] + 1, "commits": [*state["commits"], commit]})

    def _save(self, state: dict) -> None:
        text = json.dumps(state | {"schema": self.schema.jsonValue(), "cluster_by": self.cluster_by, "indexed": self.indexed})
        commit_text(self.spark, f"{self.path}/versions/{state['version']:012d}", text)

    def _index(self, data: str, spec: int) -> DataFrame:
        """Statistics of the files below ``data``, from the indexed columns alone."""
        written = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(data)
        stats = [F.count(F.lit(1)).alias("rows")]
        for c in self.indexed:
            stats += [F.min(c).alias(f"least_{c}"), F.max(c).alias(f"greatest_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
        per_file = written.select(*self.indexed, file_path().alias("file")).groupBy("file").agg(*stats)
        return per_file.select(per_file["*"], F.lit(spec).cast("long").alias("spec"))

    def _index_schema(self) -> StructType:
        fields = [StructField("file", StringType()), StructField("rows", LongType())]
        for c in self.indexed:
            kind = self.schema[c].dataType
            fields += [StructField(f"least_{c}", kind), StructField(f"greatest_{c}", kind), StructField(f"nulls_{c}", LongType())]
        return StructType([*fields, StructField("spec", LongType())])

    def index(self, version: int | None = None) -> DataFrame:
        """A row per file of the snapshot."""
        paths = [f"{self.path}/index/{c}" for c in self._state(version)["commits"]]
        return self.spark.read.schema(self._index_schema()).parquet(*paths)

    def matching_files(self, version: int | None = None, /, **ranges: Range) -> DataFrame:
        """The index rows of files that may hold rows in all ranges."""
        unknown = set(ranges) - set(self.indexed)
        if unknown:
            raise ValueError(f"not indexed: {sorted(unknown)}")
        files = self.index(version)
        for c, (low, high) in ranges.items():
            kind = self.schema[c].dataType.simpleString()
            if low is not None:
                files = files.filter(F.col(f"greatest_{c}") >= literal(low, kind))
            if high is not None:
                files = files.filter(F.col(f"least_{c}") <= literal(high, kind))
            if low is None and high is None:
                files = files.filter(F.col(f"least_{c}").isNotNull())
        return files

    def scan(self, version: int | None = None, /, **ranges: Range) -> DataFrame:
        """The rows whose columns lie in all ranges (a null lies in none); only
        matching files are listed and read."""
        paths = [r[0] for r in self.matching_files(version, **ranges).select("file").collect()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        return rows.filter(in_ranges(self.schema, ranges)) if ranges else rows


def in_ranges(schema: StructType, ranges: Mapping[str, Range]) -> Column:
    met = F.lit(True)
    for c, (low, high) in ranges.items():
        kind = schema[c].dataType.simpleString()
        met = met & F.col(c).isNotNull()
        if low is not None:
            met = met & (F.col(c) >= literal(low, kind))
        if high is not None:
            met = met & (F.col(c) <= literal(high, kind))
    return met
