"""Typed parsing of dirty text.

ANSI mode stays on, so every conversion of untrusted text goes through a
``try_`` form: a malformed value becomes NULL instead of failing the job.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats and the truthy word set of the reference.
EVENT_TIME_FORMAT = "MM/dd/yyyy hh:mm:ss a"
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TRUTHY_WORDS = ["true", "t", "1", "yes", "y"]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_event_time(col: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """``MM/dd/yyyy hh:mm:ss a`` text to a zone-less timestamp; NULL if malformed."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")


def to_bool(col: Column | str) -> Column:
    """Spark's text-to-boolean cast: true/t/1/yes/y and their negations, else NULL."""
    return _c(col).try_cast("boolean")


def to_int(col: Column | str) -> Column:
    return _c(col).try_cast("int")


def to_double(col: Column | str) -> Column:
    """Finite numbers only: NaN and the infinities are NULL, as other non-numbers."""
    d = _c(col).try_cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def truthy(col: Column | str) -> Column:
    """Producer rule: lower(trim(x)) in the truthy set, anything else is false."""
    return F.coalesce(F.lower(F.trim(_c(col))).isin(*TRUTHY_WORDS), F.lit(False))


def parse_boolean_strict(col: Column | str) -> Column:
    """Stream rule (``Boolean.parseBoolean``): only "true" in any case is true."""
    return F.coalesce(F.lower(_c(col)) == F.lit("true"), F.lit(False))


def is_blank(col: Column | str) -> Column:
    """NULL or whitespace only (the stream's blank rule)."""
    c = _c(col)
    return c.isNull() | F.regexp_like(c, F.lit(r"^\s*$"))


def is_empty(col: Column | str) -> Column:
    """NULL or the empty string (the producer's blank rule)."""
    c = _c(col)
    return c.isNull() | (c == F.lit(""))


def first_missing(cols: list[str], blank=is_blank) -> Column:
    """Name of the first field (in ``cols`` order) that is missing, else NULL."""
    out = F.lit(None).cast("string")
    for name in reversed(cols):
        out = F.when(blank(F.col(name)), F.lit(name)).otherwise(out)
    return out


def iso_utc(col: Column | str) -> Column:
    """Timestamp to ISO-8601 text with a ``Z`` suffix (session zone is UTC)."""
    return F.date_format(_c(col), ISO_UTC_FORMAT)


def parse_iso_utc(col: Column | str) -> Column:
    """ISO-8601 instant text to a zone-less UTC timestamp; NULL if malformed."""
    return F.try_to_timestamp(_c(col)).cast("timestamp_ntz")
