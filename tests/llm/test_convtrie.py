from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from blotter.llm import contraction, convtrie
from blotter.llm.catalog import ORACLE, QUERIES
from tests.oracle_harness import compare, duck

from .conftest import SF_MID

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, part string, pos int, depth int, v long"


def brute(rows):
    """Nodes as dictionaries of whole prefixes; every walk spelled out."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
        ends[whole].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        size = len(p[-1][1].encode()) if p else 0
        total[p] = (sum(total[k][0] for k in kids[p]) or 1, (len(members[p]) - 1) * size + sum(total[k][1] for k in kids[p]))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *total[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def nodes(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in convtrie.trie(df).select(*COLUMNS).collect()), key=repr)


def test_whole_small_table_against_sql(spark):
    key = "op12_conversation_trie"
    r = compare(spark, duck(SF_MID), key, QUERIES[key], ORACLE[key], SF_MID)
    assert r["status"] == "match" and "types" not in r, r


def test_edge_cases(spark):
    rnd = random.Random(5)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["", None, "a", "é"])) for c in range(60) for t in range(rnd.randrange(0, 14))]
    rows += [(101, None, "user", "first"), (101, 0, None, None), (101, 0, "user", "tie"), (101, 0, "user", "tie"), (101, None, "user", "first")]
    rows += [(None, 0, "user", "nobody"), (207, 3, "user", "x" * 100_000), (205, 1, "a", "bc"), (206, 1, "ab", "c")]
    assert nodes(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "user", "x")]) == []


def test_long_conversation_and_prefix_family(spark, monkeypatch):
    """Conversations over many blocks and tasks; a family in which every one is a
    prefix of the next; a copy of the long one that parts near its end."""
    monkeypatch.setattr(convtrie, "BLOCK_BITS", 3)
    monkeypatch.setattr(contraction, "BLOCK_BITS", 2)
    monkeypatch.setattr(contraction, "WIDER", 1)
    rows = [(5, t, "user", f"t{t % 7}") for t in range(100)] + [(10, t, "user", f"t{t % 7}" if t < 90 else "other") for t in range(110)]
    rows += [(15 + 5 * k, t, "user", f"f{t}") for k in range(12) for t in range(k + 1)]
    assert nodes(spark, rows) == brute(rows)


@pytest.mark.parametrize("shape", ["chain", "caterpillar", "random", "star", "binary", "single"])
def test_contraction(spark, monkeypatch, shape):
    """Totals against a walk, labels along the longest path or meaningless."""
    monkeypatch.setattr(contraction, "BLOCK_BITS", 2)
    rnd = random.Random(3)
    n = {"single": 1, "star": 200, "chain": 70}.get(shape, 40)
    parent = {0: None}
    for i in range(1, n):
        parent[i] = {"chain": i - 1, "star": 0, "binary": (i - 1) // 2, "random": rnd.randrange(max(0, i - 4), i),
                     "caterpillar": i - 1 if i % 2 else i - 2}.get(shape)
    depth, total = {0: 0}, {i: [1, i] for i in range(n)}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    for i in range(n - 1, 0, -1):
        for k in (0, 1):
            total[parent[i]][k] += total[i][k]
    label = {"chain": lambda i: 0, "caterpillar": lambda i: i // 2 * 2}.get(shape, lambda i: i)
    df = spark.createDataFrame([(i, parent[i], label(i), depth[i], 1, i) for i in range(n)], "v long, parent long, label long, depth long, a long, b long")
    assert {r.v: [r.a, r.b] for r in contraction.subtree_totals(df, ["a", "b"]).collect()} == total
