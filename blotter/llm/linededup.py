"""Line dedup: remove lines inside three-line windows seen before.

A document's lines are its text split at ``\\n``; blank lines (nothing but
spaces) take no part in windows and stay. A window is three consecutive lines
of what remains. Windows are ordered by (doc_id, position); each occurrence of
a window after its first covers its three lines, overlapping covers merge, and
covered lines are removed. Only DataFrame functions are used.

Null text stays null; empty text has no lines and stays empty; rows with a
null ``doc_id`` pass unchanged; rows that share a ``doc_id`` are told apart by
a hash of their text, and equal rows are cleaned alike; other columns pass
through untouched (names that begin with ``_ld_`` are reserved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

SIZE = 3


def _lines(text: Column) -> Column:
    """Lines with text, as (i, line): i numbers all lines, blank ones too."""
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    return F.filter(numbered, lambda x: F.trim(x.line) != "")


def windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, _ld_t, pos, h1, h2): one row per window; two 64-bit hashes are
    its key, and _ld_t tells rows with one doc_id apart."""
    lines = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()) \
        .select("doc_id", F.xxhash64("text").alias("_ld_t"), _lines(F.col("text")).alias("_ld_l")) \
        .where(F.size("_ld_l") >= size)

    def hashed(i: Column) -> Column:
        parts = [F.element_at("_ld_l", i + 1 + k)["line"] for k in range(size)]
        return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))

    every = F.transform(F.sequence(F.lit(0), F.size("_ld_l") - size), hashed)
    return lines.select("doc_id", "_ld_t", F.posexplode(every).alias("pos", "w")) \
        .select("doc_id", "_ld_t", "pos", "w.h1", "w.h2")


def covered(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, _ld_t, _ld_s): the positions of a document's windows that
    repeat an earlier one. First occurrences are minima counted map-side; the
    repeated windows are written out, so both sides of the join back are plain
    shuffles and a very frequent window can be split."""
    w = windows(docs, size)
    first = w.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "_ld_t", "pos")).alias("f"),
                                      F.count(F.lit(1)).alias("n"))
    repeated = cut(first.where("n > 1").select("h1", "h2", "f"), "lines")
    later = w.join(repeated, ["h1", "h2"]).where(F.struct("doc_id", "_ld_t", "pos") > F.col("f"))
    return later.groupBy("doc_id", "_ld_t").agg(F.collect_set("pos").alias("_ld_s"))


def line_dedup(docs: DataFrame, size: int = SIZE, counts: bool = False) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``; with ``counts`` also
    ``n_lines`` (lines with text) and ``n_removed``."""
    names = docs.columns
    out = docs.withColumn("_ld_t", F.xxhash64("text")).join(covered(docs, size), ["doc_id", "_ld_t"], "left")
    hit = F.col("_ld_s").isNotNull()
    raw = F.split("text", "\n")
    places = F.array_distinct(F.flatten(F.transform("_ld_s", lambda s: F.sequence(s, s + (size - 1)))))
    out = out.withColumn("_ld_l", F.when(hit | F.lit(counts), F.transform(_lines(F.col("text")), lambda x: x.i))) \
        .withColumn("_ld_raw", F.when(hit, raw)) \
        .withColumn("_ld_gone", F.when(hit, F.transform(places, lambda p: F.element_at("_ld_l", p + 1))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_ld_raw") - 1), F.col("_ld_gone"))
    text = F.array_join(F.transform(kept, lambda i: F.element_at("_ld_raw", i + 1)), "\n")
    out = out.withColumn("text", F.when(hit, text).otherwise(F.col("text")))
    if not counts:
        return out.select(*names)
    return out.select(*names, F.coalesce(F.size("_ld_l"), F.lit(0)).cast("long").alias("n_lines"),
                      F.when(hit, F.size("_ld_gone")).otherwise(0).cast("long").alias("n_removed"))
