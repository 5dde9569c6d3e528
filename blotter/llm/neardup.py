"""Embedding near-dedup by collision counting on sorted projections.

Vectors are compared only when their labels are equal and not null (and their
dimensions agree). Two link when their cosine in double precision is at least
``COSINE``.

1. Equal vectors of a label stand for their smallest vec_id, with their number.
2. The first projections deal unit vectors out to grid cells; a vector is a
   query in its own cell and data in the cells next to it. Cells above
   ``CELL`` vectors are joined in blocks, none is cut.
3. In a block ``LINES`` random projections of the data are sorted. A query's
   window on each, centred on its own value, names the data that collides; data
   with ``needed`` collisions or more is verified by exact cosine. ``needed``
   is the largest count that a pair at the threshold reaches with probability
   ``RECALL`` (binomial), and closer pairs collide more often.
4. Links are summed per query and handed on as a spanning forest, so a large
   group of near copies never leaves a task as pairs.

Vectors that are null, zero or hold null or non-finite components, and vectors
with a null label, link with nothing. Rows with a null vec_id are left out of
the result; rows that share a vec_id each give a row and count as vectors of
their own in n_links. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, components, cut, ints, ship
from .trie import Union

COSINE = 0.98
LINES = 32
SIGMAS = 2.0  # half a window, in deviations of a pair at the threshold
RECALL = 0.999
HALO = 3.5  # width of a grid cell, in the same deviations
CELL = 4096
SEED = 20


def needed(lines: int = LINES, sigmas: float = SIGMAS, recall: float = RECALL) -> int:
    """Collisions that a pair at the threshold has with probability ``recall``."""
    p = math.erf(sigmas / math.sqrt(2))
    tail, t = 0.0, lines + 1
    while tail < recall and t > 0:
        t -= 1
        tail += math.comb(lines, t) * p ** t * (1 - p) ** (lines - t)
    return t


def directions(dim: int, count: int, first: int = 0) -> np.ndarray:
    return np.random.default_rng([SEED, dim, first]).normal(size=(dim, count))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(col), -1)


def _cells(grid: int, cosine: float):
    width = HALO * math.sqrt(2 - 2 * cosine)
    schema = pa.schema([("key", pa.string()), ("cell", pa.list_(pa.int32()))])

    def run(batches):
        for b in batches:
            keys, vectors = b.column(0).to_pylist(), b.column(1)
            dims = np.array([len(v) for v in vectors])
            out = [None] * len(keys)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                cell = np.floor(_unit(_vectors(vectors.take(pa.array(at)))) @ directions(d, grid) / width).astype(np.int32)
                for i, c in zip(at, cell.tolist()):
                    out[i] = c
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.list_(pa.int32()))], schema=schema)
    return run


_OUT = pa.schema([("rep", pa.int64()), ("key", pa.string()), ("links", pa.int64()), ("root", pa.int64())])


def _search(cosine: float, lines: int):
    least = needed(lines)
    half = SIGMAS * math.sqrt(2 - 2 * cosine)

    def search(table: pa.Table) -> pa.Table:
        ask = ints(table, "ask").astype(bool)
        reps, weight, key = ints(table, "rep"), ints(table, "n"), column(table, "key").to_pylist()
        raw = _vectors(column(table, "v"))
        norm = np.linalg.norm(raw, axis=1)
        unit = raw / norm[:, None]
        lines_ = unit @ directions(raw.shape[1], lines, 1)
        data, queries = np.flatnonzero(~ask), np.flatnonzero(ask)
        order = np.argsort(lines_[data], axis=0, kind="stable")
        sorted_ = np.take_along_axis(lines_[data], order, axis=0)
        low = np.stack([np.searchsorted(sorted_[:, k], lines_[queries, k] - half, "left") for k in range(lines)], axis=1)
        high = np.stack([np.searchsorted(sorted_[:, k], lines_[queries, k] + half, "right") for k in range(lines)], axis=1)
        keys = np.array(key, object)
        links = np.zeros(len(queries), np.int64)
        union = Union(len(data) + len(queries))
        for i, q in enumerate(queries):
            if not len(data):
                break
            hit = np.bincount(np.concatenate([order[low[i, k]:high[i, k], k] for k in range(lines)]), minlength=len(data))
            near = np.flatnonzero(hit >= least)
            if not len(near):
                continue
            near = near[(raw[data[near]] @ raw[q]) / (norm[data[near]] * norm[q]) >= cosine]
            near = near[keys[data[near]] != key[q]]
            links[i] = weight[data[near]].sum()
            for j in near.tolist():
                union.add(len(data) + i, j)
        name = np.concatenate([reps[data], reps[queries]])
        smallest: dict[int, int] = {}
        for x in range(len(name)):
            r = union.find(x)
            smallest[r] = min(int(name[x]), smallest.get(r, int(name[x])))
        roots = [smallest[union.find(x)] for x in range(len(name))]
        # every member names its group's smallest rep; data only as links
        tied = [x for x in range(len(data)) if roots[x] != name[x]]
        rep = [int(reps[q]) for q in queries] + [int(name[x]) for x in tied]
        return pa.Table.from_arrays([
            pa.array(rep, pa.int64()), pa.array([key[q] for q in queries] + [None] * len(tied), pa.string()),
            pa.array(links.tolist() + [0] * len(tied), pa.int64()),
            pa.array(roots[len(data):] + [roots[x] for x in tied], pa.int64())], schema=_OUT)
    return search


def near_dedup(vectors: DataFrame, cosine: float = COSINE, lines: int = LINES, cell_size: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vector."""
    spark = vectors.sparkSession
    ship(spark)
    v = vectors.where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))
    good = F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) \
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.withColumn("key", F.when(F.coalesce(good, F.lit(False)), F.concat_ws(":", F.md5(F.col("v").cast("string")), F.col("label").cast("string"))))
    classes = cut(v.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v")), "classes")
    # as many grid projections as bring a label's cells to about CELL vectors
    most = classes.groupBy("label").count().agg(F.max("count").alias("m")).first().m or 0
    grid = min(4, max(1, math.ceil(math.log(max(1, most / cell_size), 4))))
    cells = classes.select("key", "v").mapInArrow(_cells(grid, cosine), "key string, cell array<int>")
    placed = cut(classes.join(cells, "key"), "cells")
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    spread = placed.withColumn("own", F.lit(True))
    for k in range(grid):
        spread = spread.withColumn("s", F.explode(around)).withColumn(f"c{k}", F.element_at("cell", k + 1) + F.col("s"))
    where = ["label", "dim", "at"]
    spread = spread.withColumn("at", F.array(*[f"c{k}" for k in range(grid)]))
    data = spread.select("label", F.size("v").alias("dim"), "at", "key", "rep", "n", "v")
    query = placed.select("label", F.size("v").alias("dim"), F.col("cell").alias("at"), "key", "rep", "n", "v")
    blocks = cut(query.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / cell_size).cast("int").alias("qs"))
                 .join(data.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / cell_size).cast("int").alias("ds")), where), "blocks")
    block = lambda name: F.pmod(F.xxhash64("key"), F.col(name)).cast("int")
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    asked = query.join(blocks, where).withColumn("q", block("qs")).withColumn("d", each("ds")).withColumn("ask", F.lit(True))
    given = data.join(blocks, where).withColumn("d", block("ds")).withColumn("q", each("qs")).withColumn("ask", F.lit(False))
    group = [*where, "q", "d"]
    cols = [*group, "key", "rep", "n", "v", "ask"]
    found = cut(asked.select(*cols).unionByName(given.select(*cols)).groupBy(*group)
                .applyInArrow(_search(cosine, lines), "rep long, key string, links long, root long"), "found")
    links = found.where("key is not null").groupBy("key").agg(F.sum("links").alias("links"))
    sums = cut(classes.select("key", "rep", "n").join(links, "key", "left")
               .select("key", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "sums")
    rows = v.select("vec_id", "key").join(sums, "key", "left")
    edges = found.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")) \
        .unionByName(rows.where("vec_id != rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    comps = components(edges, "vectors")
    return rows.join(comps, rows.vec_id == comps.v, "left") \
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("comp", "vec_id").alias("component_id")) \
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
