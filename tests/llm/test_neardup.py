from __future__ import annotations

import numpy as np

from blotter.llm import neardup as N
from blotter.llm.catalog import QUERIES

from .conftest import SF_MID

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    ok = [(i, np.array(e, float), y) for i, e, y in rows
          if i is not None and y is not None and e and all(x is not None for x in e) and np.isfinite(e).all() and np.any(np.array(e, float))]
    links, parent = [0] * len(ok), {}
    find = lambda x: x if parent.get(x, x) == x else find(parent[x])
    for a in range(len(ok)):
        for b in range(a):
            (i, x, y), (j, z, w) = ok[a], ok[b]
            if y == w and len(x) == len(z) and x @ z / (np.linalg.norm(x) * np.linalg.norm(z)) >= least:
                links[a] += 1
                links[b] += 1
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    out = [(i, n, find(i)) for (i, *_), n in zip(ok, links)]
    rest = [(i, 0, find(i)) for i, e, y in rows if i is not None
            and not (y is not None and e and all(x is not None for x in e) and np.isfinite(e).all() and np.any(np.array(e, float)))]
    return sorted((i, n, c, i == c) for i, n, c in out + rest)


def test_whole_small_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in QUERIES["op10_embedding_near_dedup"](spark, SF_MID).collect())
    want = brute(rows)
    assert got == want


def planted(n=240, dim=32, seed=1):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = rnd.normal(size=dim)
        for _ in range(rnd.integers(1, 4)):
            noise = rnd.normal(size=dim)
            noise *= np.linalg.norm(base) / np.linalg.norm(noise) * rnd.uniform(0, 0.3)
            rows.append([0, (base + noise).astype(np.float32).tolist(), int(rnd.integers(0, 2))])
    rows += [[0, rows[5][1], rows[5][2]] for _ in range(30)]
    return [(k, e, y) for k, (_, e, y) in enumerate(rows)]


def test_recall_and_blocks(spark):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA)
    want = {i: n for i, n, *_ in brute(rows)}
    for size in (4096, 60):
        got = {r.vec_id: r.n_links for r in N.near_dedup(df, cell_size=size).collect()}
        assert all(got[i] <= want[i] for i in want)
        assert sum(got.values()) >= 0.98 * sum(want.values())


def test_edge_cases(spark):
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [1.0, 2.0], 1), (7, [2.0, 4.0], 1),
            (8, [1.0, 2.0], None), (9, [1.0, 2.0, 0.0], 1), (10, [1.0, 2.0], 1), (11, [1.0, 2.0], 2), (None, [1.0, 2.0], 1), (12, [float("inf"), 1.0], 1),
            (6, [1.0, 2.0], 1), (13, [-1.0, -2.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as rep", "3 as cell", "4 as n")
    assert sorted(tuple(r) for r in N.near_dedup(df).collect()) == brute(rows)
    assert N.near_dedup(df.limit(0)).count() == 0


def test_needed_count():
    assert 0 < N.needed() < N.LINES and N.needed(recall=0.9) >= N.needed(recall=0.999)
