"""Small text and number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank: spaces of all widths, no-break spaces, line and field ends.
_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(text) -> Column:
    """Drop blanks at both ends; unlike plain ``trim`` this covers no-break spaces and line ends."""
    return F.btrim(text, F.lit(_BLANKS))


def first_non_empty(*values: Column) -> Column:
    return F.coalesce(*[F.when(value != "", value) for value in values])


def extract(text, pattern: str, group: int) -> Column:
    """``regexp_extract`` that yields null, not "", where the pattern does not match."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def require(ok: Column, message: Column | str) -> Column:
    """True where ``ok`` holds; the job fails with ``message`` anywhere else. Use it as a filter."""
    message = F.lit(message) if isinstance(message, str) else message
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def is_zero(value: Column, tolerance: float = 1e-4) -> Column:
    return F.abs(value) < tolerance
