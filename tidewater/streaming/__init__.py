from tidewater.streaming.joins import stream_static_join, stream_stream_join
from tidewater.streaming.sinks import (
    batch_log,
    read_json_batches,
    record_arrivals,
    run_append,
    run_complete,
    run_epochs,
    run_interval,
    run_keyed,
    run_per_batch,
    start_append,
    write_json_per_batch,
)
from tidewater.streaming.sources import (
    csv_stream,
    json_stream,
    parse_csv_lines,
    parse_json_lines,
    table_stream,
    text_stream,
)
from tidewater.streaming.windows import processing_time_sum, top_item_per_window, windowed_sum, with_event_time

__all__ = [
    "csv_stream", "json_stream", "parse_csv_lines", "parse_json_lines", "processing_time_sum",
    "batch_log", "read_json_batches", "record_arrivals", "run_append", "run_complete", "run_epochs", "run_interval", "run_keyed", "run_per_batch", "stream_static_join",
    "stream_stream_join", "start_append", "table_stream", "text_stream", "top_item_per_window", "windowed_sum", "with_event_time",
    "write_json_per_batch",
]
