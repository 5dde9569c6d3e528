"""Helpers shared by the operators: shared-folder tables, task sizing,
packed exchanges, connected components."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per session)."""
    sc = spark.sparkContext
    if getattr(sc, "_blotter_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="blotter-py-"), "blotter_pkg.zip")
    root = os.path.dirname(_PACKAGE)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._blotter_shipped = True


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage
    and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:6]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def layout(spark: SparkSession, n_docs: int) -> tuple[int, int]:
    """(chunks, buckets) of a packed exchange. A chunk is what one call of a
    mapper holds, a bucket what one call of a reducer holds: buckets follow the
    session's shuffle partitions and hold 20,000 documents' entries at most on
    average; chunks keep about 32 entries or more per (chunk, bucket) row."""
    buckets = max(shuffle_partitions(spark), -(-n_docs // 20_000))
    per_chunk = max(400, buckets // 16)
    return max(1, -(-n_docs // per_chunk)), buckets


def with_chunk(df: DataFrame, key: str, chunks: int) -> DataFrame:
    return df.withColumn("chunk", F.pmod(F.xxhash64(F.col(key)), F.lit(chunks)))


def column(table: pa.Table, name: str) -> pa.Array:
    col = table.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    return col


def ints(table: pa.Table, name: str) -> np.ndarray:
    return column(table, name).to_numpy(zero_copy_only=False)


def copies_of(docs: DataFrame, name: str, key: str = "doc_id", content=None) -> DataFrame:
    """(doc_id, hash, rep): rows whose content equals that of a row with a
    smaller key, which is ``rep``. Contents meet by their MD5, counted map-side
    first; the groups are written out so the join back can be split on a hot
    content. A key may stand on rows of several contents: (key, hash) names
    the copy."""
    content = F.md5(F.col("text")) if content is None else content
    keyed = docs.select(F.col(key), content.alias("hash")).where(F.col("hash").isNotNull())
    groups = cut(keyed.groupBy("hash").agg(F.min(key).alias("rep"), F.count(F.lit(1)).alias("_n"))
                 .where("_n > 1").select("hash", "rep"), name)
    return keyed.join(groups, "hash").where(F.col(key) != F.col("rep")).select(key, "hash", "rep")


def is_copy(docs: pa.Table, drop: set[tuple[int, bytes]]) -> np.ndarray:
    """Rows whose (doc_id, MD5 of the text) is in ``drop``; only texts of
    doc_ids in there are hashed."""
    ids = ints(docs, "doc_id").tolist()
    known = {i for i, _ in drop}
    out = np.zeros(len(ids), bool)
    texts = column(docs, "text")
    for at, i in enumerate(ids):
        if i in known:
            text = texts[at].as_py()
            out[at] = text is not None and (i, hashlib.md5(text.encode()).digest()) in drop
    return out


def _forest(batches):
    """Spanning forest of each task's edges: at most one edge per vertex leaves."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                parent.setdefault(min(x, y), min(x, y))
        if len(parent) >= 1_000_000:  # bounded state: a forest of what was seen so far
            out = [(v, find(v)) for v in parent if find(v) != v]
            yield pa.RecordBatch.from_arrays([pa.array([r for _, r in out], pa.int64()),
                                              pa.array([v for v, _ in out], pa.int64())], ["a", "b"])
            parent.clear()
    out = [(v, find(v)) for v in list(parent) if find(v) != v]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r for _, r in out], pa.int64()),
                                          pa.array([v for v, _ in out], pa.int64())], ["a", "b"])


def components(edges: DataFrame, name: str) -> DataFrame:
    """(v, comp) for every vertex of the links (a, b): the smallest vertex
    reachable. Alternating large-star and small-star steps; each round is a
    table in the shared folder and only a row count reaches the driver. Both
    steps take minima per vertex (counted map-side), so a vertex with very
    many links needs no list."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    now = cut(pairs.mapInArrow(_forest, "b long, a long").select("a", "b").distinct(), name)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # large star: neighbours above the vertex attach to its minimum
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a > b").distinct()
        # small star: the vertex and its smaller neighbours attach to the minimum
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a")
        step = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b") \
            .unionByName(small_low.select("a", F.col("m").alias("b"))).distinct()
        new = cut(step, name)
        # settled: every vertex has one link and no root hangs below another
        roots = new.select(F.col("b").alias("a")).distinct()
        open_ = new.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a").limit(1).count() \
            or new.join(roots, "a", "left_semi").limit(1).count()
        now = new
        if not open_:
            break
    comps = now.select(F.col("a").alias("v"), F.col("b").alias("comp"))
    return comps.unionByName(now.select(F.col("b").alias("v"), F.col("b").alias("comp")).distinct())
