from __future__ import annotations

import random
import re

import numpy as np
import pytest

from blotter.llm import jaccard
from blotter.llm.trie import links

from .conftest import SF_MID, docs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    """Every candidate pair that shares a shingle, compared set by set."""
    sets = {}
    for i, t in rows:
        sets[i] = shingle_set(t)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    seen = {(a, b) for v in index.values() for a in v for b in v if a < b}
    for a, b in seen:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 75 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near_copies(seed, base_words, copies, edits):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(base_words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_whole_small_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(jaccard.jaccard_components(docs)) == brute(rows)


@pytest.mark.parametrize("block", [512, 8])
def test_groups_larger_than_a_block(spark, block):
    texts = near_copies(1, 60, 60, 3) + near_copies(2, 40, 30, 2) + near_copies(3, 200, 5, 8)
    rows = list(enumerate(texts))
    assert got(jaccard.jaccard_components(docs_of(spark, rows), block_size=block)) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one two three"),
            (7, "a b c d e"), (8, "A B  C\nD E"), (9, ""), (10, "a b c d e f"), (11, "x " * 50000), (12, "x " * 6)]
    assert got(jaccard.jaccard_components(docs_of(spark, rows))) == brute(rows)
    assert got(jaccard.jaccard_components(docs_of(spark, []))) == {}
    with_null = docs_of(spark, rows + [(None, "one two"), (None, None)])
    assert got(jaccard.jaccard_components(with_null)) == brute(rows)
    clash = docs_of(spark, rows).selectExpr("*", "1 as chunk", "2 as bucket", "3 as keys", "4 as block", "5 as n")
    kept = jaccard.jaccard_dedup(clash)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in brute(rows).items() if v[1] == k)


def test_repeated_rows(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g")]
    out = sorted(tuple(r) for r in jaccard.jaccard_components(docs_of(spark, rows)).collect())
    assert out == [(1, 3, 1), (1, 3, 1), (2, 3, 1)]


def test_texts_that_share_a_doc_id(spark):
    """Each text is linked by itself: B is no copy of A though a copy of A has its doc_id."""
    a, b, c = "a b c d e f g", "h i j k l m n", "h i j k l m n o"
    rows = [(1, a), (5, a), (5, b), (5, b), (7, c), (7, None), (8, ""), (8, "p q r s t"), (None, b)]
    docs = docs_of(spark, rows)
    out = sorted(tuple(r) for r in jaccard.jaccard_components(docs).collect())
    assert out == [(1, 3, 1), (5, 3, 1), (5, 3, 5), (5, 3, 5), (7, 0, 7), (7, 4, 5), (8, 0, 8), (8, 1, 8)]
    kept = sorted(((r.doc_id, r.text) for r in jaccard.jaccard_dedup(docs).collect()), key=repr)
    assert kept == sorted([(1, a), (5, b), (5, b), (7, None), (8, ""), (8, "p q r s t"), (None, b)], key=repr)
    two = docs_of(spark, [(3, b), (3, c), (9, "z z z z z")])  # near copies under one doc_id: one stays
    assert sorted((r.doc_id for r in jaccard.jaccard_dedup(two).collect())) == [3, 9]


def test_tree_against_all_pairs():
    rnd = np.random.default_rng(5)
    sets = []
    for _ in range(12):
        base = rnd.choice(400, 60, replace=False)
        for _ in range(6):
            s = set(base.tolist())
            for _ in range(rnd.integers(0, 14)):
                s.discard(int(rnd.choice(base)))
                s.add(int(rnd.integers(0, 400)))
            sets.append(np.array(sorted(s), np.uint64))
    sizes = np.array([len(s) for s in sets])
    u = links(sets, sizes, 75, 100)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if 100 * inter >= 75 * (sizes[i] + sizes[j] - inter):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert [u.find(i) for i in range(len(sets))] == [find(i) for i in range(len(sets))]
