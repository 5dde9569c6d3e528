"""Substring dedup: remove word passages that an earlier document has too.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, unchanged. A word goes when
a window of ``WINDOW`` consecutive words of its document covers it whose word
sequence also starts in a document with a smaller doc_id. Windows are judged on
the input.

1. Anchors: every document is cut into non-overlapping blocks of
   ``WINDOW // 2`` words. A repeat of ``WINDOW`` words holds a whole block of
   the other document, wherever it starts.
2. Every rolling window of block length probes the blocks in a packed
   exchange; a position is a hit when its words are a block somewhere and occur
   in two documents or more.
3. Each hit is extended, to both sides, to all the ``WINDOW``-word windows
   around it; their 96-bit hashes meet in a second exchange, which says of each
   whether a smaller doc_id has it. Covered windows merge into maximal repeats.

Exact copies are set aside first (all of a copy of ``WINDOW`` words or more
goes), so a large group of copies is never exchanged. Null and empty texts have
no words. Rows with a null ``doc_id`` are left out of the result; rows that
share a ``doc_id`` each give a row and do not remove each other's words. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, copies_of, cut, ints, is_copy, layout, ship, with_chunk
from .packed import ROW, bucket_edges, distinct, rows
from .text import flat, hash_spans, mix, slices, window_hash, window_starts, words

WINDOW = 50
_SECOND = 1 << 20  # bucket numbers of the second exchange's answers
RESULT = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                     ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


class _Chunk:
    """A chunk's documents by doc_id, their words and rolling hashes."""

    def __init__(self, docs: pa.Table, side: pa.Table, window: int):
        bucket = np.asarray(side.column("bucket").to_pylist(), np.int64)
        ref = side.column("ref").to_pylist()
        payload = side.column("payload")
        self.drop = {(ref[i], payload[i].as_py()) for i in np.flatnonzero(bucket == -1).tolist()}
        ids = ints(docs, "doc_id")
        copy = is_copy(docs, self.drop)
        order = np.argsort(ids, kind="stable")
        self.docs = docs.take(pa.array(order[~copy[order]]))
        self.copies = docs.take(pa.array(order[copy[order]]))
        self.ids = ints(self.docs, "doc_id")
        self.side, self.bucket = side, bucket
        self.window, self.block = window, window // 2
        raw, offsets = flat(column(self.docs, "text"))
        self.raw = raw
        hashes, starts, ends, first, base = [], [], [], [np.zeros(1, np.int64)], 0
        for i, j in slices(offsets):
            w = words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            hashes.append(hash_spans(w.raw, w.start, w.end))
            starts.append(w.start + offsets[i])
            ends.append(w.end + offsets[i])
            first.append(w.first[1:] + base)
            base += len(w.start)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.h = cat(hashes, np.uint64)
        self.start, self.end = cat(starts, np.int64), cat(ends, np.int64)
        self.first = np.concatenate(first)
        self.of = np.repeat(self.ids, np.diff(self.first))  # doc_id of each word

    def anchors(self):
        """Sorted distinct block-length hashes, their order, and flags."""
        r = window_hash(self.h, self.block)
        long = np.diff(self.first) >= self.window
        ok = window_starts(self.first, self.block, len(r))
        ok &= np.repeat(long, np.diff(self.first))[:len(r)]
        self.at = np.flatnonzero(ok)
        keys = r[self.at]
        order = np.argsort(keys, kind="stable")
        sorted_ = keys[order]
        new = distinct(sorted_)
        first = np.flatnonzero(new)
        self.anchor_order, self.anchor_group = order, np.cumsum(new) - 1
        place = self.at - np.repeat(self.first[:-1], np.diff(self.first))[self.at]
        aligned = (place % self.block == 0)[order]
        ids = self.of[self.at][order]
        if len(first):
            last = np.append(first[1:], len(sorted_)) - 1
            flags = np.logical_or.reduceat(aligned, first).astype(np.uint32) | ((ids[first] != ids[last]) * 2).astype(np.uint32)
        else:
            flags = np.zeros(0, np.uint32)
        return sorted_[first], flags

    def bits(self, low: int, high: int) -> np.ndarray:
        """The answers from buckets low..high-1, in order."""
        payload = self.side.column("payload")
        pick = [i for i in np.argsort(self.bucket, kind="stable") if low <= self.bucket[i] < high]
        parts = []
        for i in pick:
            p = payload[int(i)].as_py()
            n = int(np.frombuffer(p[:4], "<u4")[0])
            parts.append(np.unpackbits(np.frombuffer(p, np.uint8, offset=4), count=n).astype(bool))
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    def candidates(self):
        """Windows around a hit: sorted distinct (key, extra), first doc_id."""
        self.anchors()
        hit = np.zeros(len(self.h) + 1, np.int64)
        answer = self.bits(0, _SECOND)
        mine = np.zeros(len(self.at), bool)
        mine[self.anchor_order] = answer[self.anchor_group] if len(answer) else False
        hit[self.at[mine]] = 1
        seen = np.concatenate([[0], np.cumsum(hit)])
        k = window_hash(self.h, self.window)
        s = np.flatnonzero(window_starts(self.first, self.window, len(k)))
        s = s[seen[s + self.window - self.block + 1] > seen[s]]
        extra = window_hash(mix(self.h ^ np.uint64(0x5851F42D4C957F2D)), self.window)[s].astype(np.uint32) if len(s) else np.zeros(0, np.uint32)
        k, ids = k[s], self.of[s]
        order = np.lexsort((s, extra, k))
        self.win = s[order]
        k, extra, ids = k[order], extra[order], ids[order]
        new = distinct(k)
        new[1:] |= extra[1:] != extra[:-1]
        first = np.flatnonzero(new)
        self.win_group = np.cumsum(new) - 1
        self.win_ids = ids
        self.win_first = ids[first]
        return k[first], extra[first], ids[first]


def _empty() -> pa.Table:
    return rows(0, [])


def _probe(window: int, buckets: int):
    def send(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _empty()
        keys, flags = _Chunk(docs, side, window).anchors()
        edges = bucket_edges(keys, buckets)
        low = (keys.astype("<u4") & np.uint32(0xFFFFFFFC)) | flags.astype("<u4")
        return rows(docs.column("chunk")[0].as_py(),
                    [(b, low[edges[b]:edges[b + 1]].tobytes()) for b in range(buckets) if edges[b + 1] > edges[b]])
    return send


def _packed(bits: np.ndarray) -> bytes:
    return np.array([len(bits)], "<u4").tobytes() + np.packbits(bits).tobytes()


def _reply(table: pa.Table, each: list[np.ndarray], shift: int) -> pa.Table:
    bucket = [b + shift for b in table.column("bucket").to_pylist()]
    return pa.table({"chunk": table.column("chunk"), "bucket": pa.array(bucket, pa.int32()),
                     "ref": table.column("ref"), "payload": pa.array([_packed(x) for x in each], pa.binary())})


def _hits(table: pa.Table) -> pa.Table:
    """Of each probe of a bucket: is it a block somewhere, and in two documents?"""
    parts = [np.frombuffer(p, "<u4") for p in table.column("payload").to_pylist()]
    got = np.concatenate(parts)
    _, inverse = np.unique(got >> np.uint32(2), return_inverse=True)
    aligned = np.bincount(inverse, weights=got & np.uint32(1)) > 0
    several = (np.bincount(inverse) > 1) | (np.bincount(inverse, weights=got & np.uint32(2)) > 0)
    hit = (aligned & several)[inverse]
    return _reply(table, np.split(hit, np.cumsum([len(p) for p in parts])[:-1]), 0)


_ENTRY = np.dtype([("key", "<u8"), ("extra", "<u4"), ("doc", "<i8")])


def _extend(window: int, buckets: int):
    def send(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _empty()
        keys, extra, ids = _Chunk(docs, side, window).candidates()
        out = np.empty(len(keys), _ENTRY)
        out["key"], out["extra"], out["doc"] = keys, extra, ids
        edges = bucket_edges(keys, buckets)
        return rows(docs.column("chunk")[0].as_py(),
                    [(b, out[edges[b]:edges[b + 1]].tobytes()) for b in range(buckets) if edges[b + 1] > edges[b]])
    return send


def _older(table: pa.Table) -> pa.Table:
    """Of each window of a bucket: does a smaller doc_id have it?"""
    parts = [np.frombuffer(p, _ENTRY) for p in table.column("payload").to_pylist()]
    got = np.concatenate(parts)
    order = np.lexsort((got["doc"], got["extra"], got["key"]))
    key, extra, doc = got["key"][order], got["extra"][order], got["doc"][order]
    new = distinct(key)
    new[1:] |= extra[1:] != extra[:-1]
    least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    older = np.empty(len(got), bool)
    older[order] = least < doc
    return _reply(table, np.split(older, np.cumsum([len(p) for p in parts])[:-1]), _SECOND)


def _result(ids, raw, start, end, first, gone) -> list[tuple]:
    out = []
    for i, doc in enumerate(ids.tolist()):
        a, b = int(first[i]), int(first[i + 1])
        g = gone[a:b]
        keep = np.flatnonzero(~g) + a
        kept = b" ".join([raw[s:e].tobytes() for s, e in zip(start[keep].tolist(), end[keep].tolist())]).decode()
        edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
        out.append((doc, b - a, int(g.sum()), kept, [{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)]))
    return out


def _finish(window: int):
    def finish(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _SCHEMA.empty_table()
        c = _Chunk(docs, side, window)
        c.candidates()
        older = c.bits(_SECOND, 2 * _SECOND)
        gone = np.zeros(len(c.h), bool)
        if len(c.win):
            hit = older[c.win_group] | (c.win_ids > c.win_first[c.win_group])
            edge = np.zeros(len(c.h) + 1, np.int64)
            np.add.at(edge, c.win[hit], 1)
            np.add.at(edge, c.win[hit] + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
        out = _result(c.ids, c.raw, c.start, c.end, c.first, gone)
        if c.copies.num_rows:
            raw, offsets = flat(column(c.copies, "text"))
            w = words(raw, offsets)
            gone = np.repeat(np.diff(w.first) >= window, np.diff(w.first))
            out += _result(ints(c.copies, "doc_id"), raw, w.start, w.end, w.first, gone)
        return pa.Table.from_arrays([pa.array([r[i] for r in out], _SCHEMA.field(i).type) for i in range(5)], schema=_SCHEMA)
    return finish


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed): the kept words joined by
    one space, and the removed word ranges (end exclusive)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.where(F.col("doc_id").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks, buckets = layout(spark, docs.count())
    base = with_chunk(docs, "doc_id", chunks)
    copies = cut(copies_of(docs, "copies"), "copies")
    dropped = with_chunk(copies, "doc_id", chunks).select(
        "chunk", F.lit(-1).alias("bucket"), F.col("doc_id").alias("ref"), F.unhex("hash").alias("payload"))
    probes = base.groupBy("chunk").cogroup(dropped.groupBy("chunk")).applyInArrow(_probe(window, buckets), ROW)
    side = dropped.unionByName(probes.groupBy("bucket").applyInArrow(_hits, ROW))
    near = base.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(_extend(window, buckets), ROW)
    full = side.unionByName(near.groupBy("bucket").applyInArrow(_older, ROW))
    return base.groupBy("chunk").cogroup(full.groupBy("chunk")).applyInArrow(_finish(window), RESULT)
