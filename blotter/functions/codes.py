"""Key normalisers: three rules that turn a raw code into a key.

All are Column -> Column expressions, evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_code(col: Column | str, width: int = 3, mode: str = "first_run",
                   on_empty: str | None = None, truncate: bool = False) -> Column:
    """Normalise a code to ``width`` digits.

    ``mode="first_run"`` keeps the first run of digits of the trimmed text (the
    batch rule); ``mode="all_digits"`` drops every non-digit and reads the rest
    as an int (the stream rule, NULL when it overflows an int). Text without
    digits gives ``on_empty`` (NULL by default, ``"000"`` for stream parity).
    Longer codes are kept whole unless ``truncate=True`` (batch parity: lpad
    cuts them to ``width``).
    """
    c = _c(col)
    if mode == "first_run":
        digits = F.regexp_extract(F.trim(c), r"(\d+)", 1)
        if truncate:
            padded = F.lpad(digits, width, "0")
        else:
            padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
        out = F.when(F.length(digits) > 0, padded)
    elif mode == "all_digits":
        digits = F.regexp_replace(c, r"\D", "")
        as_int = digits.try_cast("int")
        out = F.when((F.length(digits) > 0) & as_int.isNotNull(),
                     F.format_string(f"%0{width}d", as_int))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if on_empty is not None:
        out = F.when(c.isNull(), F.lit(None).cast("string")).when(
            F.length(digits) == 0, F.lit(on_empty)).otherwise(out)
    return out


def batch_code(col: Column | str) -> Column:
    """Batch parity: first digit run, lpad to 3 (cuts longer codes)."""
    return normalize_code(col, 3, "first_run", None, truncate=True)


def stream_code(col: Column | str) -> Column:
    """Stream parity: all digits as int, ``%03d``, ``000`` when no digit."""
    return normalize_code(col, 3, "all_digits", on_empty="000")


def zfill_code(col: Column | str, width: int = 3) -> Column:
    """Producer parity: strip, then left-pad with zeros to ``width``."""
    t = F.trim(_c(col))
    return F.when(F.length(t) < width, F.lpad(t, width, "0")).otherwise(t)
