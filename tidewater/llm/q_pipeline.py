"""The corpus pipeline as a query."""

from __future__ import annotations

import corpus_pipeline
from tidewater.llm.registry import register

register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
