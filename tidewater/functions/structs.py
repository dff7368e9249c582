"""JSON, struct and map helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parse_json(col: Column | str, schema: StructType | str) -> Column:
    """``from_json`` with a declared schema; malformed text gives null fields."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema)


def map_text(col: Column | str) -> Column:
    """Render a map as ``k:v,k:v`` sorted by key (stable text for comparisons)."""
    c = F.col(col) if isinstance(col, str) else col
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(
        F.transform(entries, lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))),
        ",",
    )
