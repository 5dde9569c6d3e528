"""Packed exchange: membership counts of very many hashes with small shuffles.

A mapper call holds one chunk of documents and sends, per bucket, one row with
the chunk's distinct 64-bit hashes cut to 32 bits (buckets are ranges of the
upper bits, so bits are not lost twice). The reducer of a bucket answers with
one small row per chunk, in the order of the entries it got. A mapper that
recomputes the chunk's sorted distinct hashes lines the answers up again, so
neither positions nor document ids travel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

ROW = "chunk long, bucket int, ref long, payload binary"


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted 64-bit ``keys`` (buckets + 1)."""
    high = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(high, np.arange(buckets + 1, dtype=np.uint64))


def rows(chunk: int, items: list[tuple[int, bytes]]) -> pa.Table:
    """Rows of one chunk: (bucket, payload) each."""
    return pa.table({"chunk": pa.array([chunk] * len(items), pa.int64()),
                     "bucket": pa.array([b for b, _ in items], pa.int32()),
                     "ref": pa.nulls(len(items), pa.int64()),
                     "payload": pa.array([p for _, p in items], pa.binary())})


def answers(side: pa.Table, dtype) -> np.ndarray:
    """The reducers' answers of a chunk, in bucket order, as one array."""
    bucket = np.asarray(side.column("bucket").to_pylist(), dtype=np.int64)
    payload = side.column("payload").to_pylist()
    parts = [np.frombuffer(payload[i], dtype) for i in np.argsort(bucket, kind="stable") if bucket[i] >= 0]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def distinct(sorted_values: np.ndarray) -> np.ndarray:
    """Mask of the first of equal neighbours."""
    first = np.ones(len(sorted_values), dtype=bool)
    first[1:] = sorted_values[1:] != sorted_values[:-1]
    return first
