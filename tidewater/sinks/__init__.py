from tidewater.sinks.compaction import compact, file_report, write_by_task
from tidewater.sinks.evolving import EvolvingTable
from tidewater.sinks.keyed import KeyedTable, keyed_upsert
from tidewater.sinks.manifest import CommitConflict
from tidewater.sinks.tables import (
    create_database,
    create_table_as,
    describe_extended,
    drop_table,
    parquet_roundtrip,
    save_bucketed,
    save_partitioned,
    save_table,
    schema_profile,
    write_parquet,
)

__all__ = [
    "CommitConflict", "EvolvingTable", "KeyedTable", "compact", "create_database", "create_table_as", "describe_extended", "drop_table",
    "file_report", "keyed_upsert", "parquet_roundtrip", "save_bucketed", "save_partitioned", "save_table", "schema_profile",
    "write_by_task", "write_parquet",
]
