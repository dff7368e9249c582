"""Queries of the training-data operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = (fn, sql.strip() if sql else None)
        return fn

    return deco


def _load() -> None:
    # importing the modules registers their queries
    for module in ("q_licenses", "q_langid", "q_mixing", "q_viterbi", "q_bpe", "q_neighbours", "q_chat", "q_near_dedup", "q_fingerprints", "q_sharding", "q_secrets", "q_repair", "q_alignment", "q_pipeline"):
        importlib.import_module(f"tidewater.llm.{module}")


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: fn for k, (fn, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: sql for k, (_, sql) in _QUERIES.items() if sql}
