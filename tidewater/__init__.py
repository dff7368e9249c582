"""tidewater: analytics operators written as PySpark DataFrame / SQL plans.

Every operator is a function ``DataFrame (+ params) -> DataFrame`` (or a sink
function). Catalyst plans the work; nothing here collects rows to the driver.

    sources     table scans and file readers with declared schemas
    sinks       parquet / CSV / JSON / partitioned / bucketed tables, keyed upsert
    functions   column expressions (strings, time, casts, exact means, JSON, UDFs)
    operators   projections, filters, joins, aggregates, ranking, partitioning
    streaming   stream sources, windows, stream joins, sinks and runners
    plans       the registered queries over the test tables and their oracle SQL
"""

from tidewater.session import build_session, shared_path

__all__ = ["build_session", "shared_path"]
