"""Deterministic hash bucketing.

``murmur`` is the reference rule ``pmod(abs(hash(coalesce(x, ''))), N)`` with
the hash widened to long so ``abs`` cannot overflow under ANSI. ``md5`` takes
the first 32 bits of the MD5 digest; it is portable to other engines, which is
what the SQL oracle needs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bucket(col: Column | str, n: Column | int, method: str = "murmur") -> Column:
    """Bucket in ``[0, n)``; NULL and '' share a bucket; NULL when ``n`` is 0."""
    key = F.coalesce(_c(col), F.lit(""))
    n_col = n if isinstance(n, Column) else F.lit(int(n))
    n_col = n_col.cast("long")
    if method == "murmur":
        h = F.abs(F.hash(key).cast("long"))
    elif method == "md5":
        h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    else:
        raise ValueError(f"unknown hash method {method!r}")
    return F.when(n_col > 0, F.pmod(h, n_col))
