from tidewater.functions.casts import bad_int_count, is_bad_int, tolerant_int
from tidewater.functions.scoring import band_score
from tidewater.functions.strings import (
    first_token,
    regex_literal,
    split_on,
    strip_chars,
)
from tidewater.functions.structs import map_text, parse_json
from tidewater.functions.temporal import hour_minute, month_of, parse_time, year_of

__all__ = [
    "band_score", "bad_int_count", "first_token", "hour_minute",
    "is_bad_int", "map_text", "month_of", "parse_json", "parse_time", "regex_literal", "split_on",
    "strip_chars", "tolerant_int", "year_of",
]
