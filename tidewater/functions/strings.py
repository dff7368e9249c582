"""String expressions (E1, E4-E9). All built-in, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_SPECIAL = set(".^$*+?()[]{}|\\")


def regex_literal(text: str) -> str:
    """Escape a literal separator for ``split`` (which takes a regex): ' | ' -> ' \\| '."""
    return "".join("\\" + c if c in _REGEX_SPECIAL else c for c in text)


def split_on(col: Column | str, sep: str = " ") -> Column:
    """Split on a literal separator, keeping empty pieces (limit -1)."""
    return F.split(_c(col), regex_literal(sep), -1)


def strip_chars(col: Column | str, chars: str) -> Column:
    """E5: delete every occurrence of each character in ``chars`` (quotes, brackets)."""
    return F.translate(_c(col), chars, "")


def first_token(col: Column | str, sep: str = " ") -> Column:
    """Text before the first separator (whole text when there is none)."""
    return F.substring_index(_c(col), sep, 1)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
