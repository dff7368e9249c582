"""Name -> (Spark query, DuckDB oracle SQL).

A query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
TESTDATA tables. The oracle is independent ANSI SQL over the same tables
(views named after the tables); ``None`` marks a query whose result is not
expressible in SQL (physical layout, processing time) and is checked by rows
and by tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]


_ENTRIES: dict[str, Entry] = {}


def register(name: str, sql: str | None, ops: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _ENTRIES:
            raise ValueError(f"duplicate query {name}")
        _ENTRIES[name] = Entry(name, fn, sql.strip() if sql else None, ops)
        return fn

    return deco


def entries() -> dict[str, Entry]:
    _load()
    return dict(_ENTRIES)


def queries() -> dict[str, QueryFn]:
    return {k: e.fn for k, e in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in entries().items() if e.sql}


def _load() -> None:
    # importing the modules registers their queries
    from tidewater.plans import access_log, batch, catalog, course_scores, fire_calls, formats, layout, streams  # noqa: F401
