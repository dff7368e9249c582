from tidewater.sources.files import (
    infer_csv,
    infer_json,
    read_delimited,
    read_json_lines,
    read_lines,
    rows_to_frame,
)
from tidewater.sources.tables import (
    TABLES,
    number_range,
    read_catalog_table,
    read_parquet,
    read_table,
    register_views,
    table_path,
)

__all__ = [
    "TABLES", "infer_csv", "infer_json", "number_range", "read_catalog_table", "read_delimited",
    "read_json_lines", "read_lines", "read_parquet", "read_table", "register_views", "rows_to_frame",
    "table_path",
]
