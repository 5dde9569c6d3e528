from __future__ import annotations

import math
import random
import re

from blotter.llm import decontam as D

from .conftest import SF_MID, docs_of

TERM = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def low(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items):
    """Exact BM25 of every passage with every item, then the overlap check."""
    items = [(i, t, low(t)) for i, t in items if t and low(t)]
    n, mean = len(items), sum(len(w) for *_, w in items) / max(1, len(items))
    df = {}
    for *_, w in items:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    size = max(D.LEAST_PASSAGE, 2 * max([len(w) for *_, w in items], default=0))
    grams = lambda w, k: {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    out = set()
    for doc, text in docs:
        w = low(text)
        starts = range(0, max(1, -(-len(w) // (size // 2)) - 1) * (size // 2), size // 2) if w else []
        for s in starts:
            p = w[s:s + size] if s != list(starts)[-1] else w[s:]
            have = set(p)
            for i, t, q in items:
                imp = {x: math.log(1 + (n - df[x] + .5) / (df[x] + .5)) * q.count(x) * 2.2
                       / (q.count(x) + 1.2 * (.25 + .75 * len(q) / mean)) for x in set(q)}
                if sum(v for x, v in imp.items() if x in have) < D.RATIO * sum(imp.values()) * (1 - 1e-9):
                    continue
                if len(q) < D.SHORT:
                    if w == q:
                        out.add((doc, i))
                    continue
                parts = [x for x in re.split(r"(?<=[.!?])\s+", t) if low(x)]
                a = len(low(parts[-1])) if len(parts) > 1 else -(-len(q) // 3)
                ok = True
                for part in (q[:len(q) - a], q[len(q) - a:]):
                    k = min(5, len(part))
                    if k:
                        g = grams(part, k)
                        ok &= len(g & grams(p, k)) / len(g) >= D.OVERLAP
                if ok:
                    out.add((doc, i))
    return out


def pairs(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


def test_whole_small_table_against_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    d, i = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    want = brute(d, i)
    verbatim = {(a, b) for a, t in d for b, u in i if u in (t or "")}
    assert pairs(D.contaminated(docs, items)) == want and verbatim and verbatim <= want


def test_planted_items_shards_and_edge_cases(spark):
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randrange(3000)}"
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, f"{text(20).capitalize()}. {text(8)}.") for i in range(30)] + [(40, None), (41, ""), (42, "Yes no."), (43, "Yes no."),
                                                                               (44, text(150) + ". " + text(4)), (45, "!!")]
    docs = [(100 + i, f"{text(rnd.randrange(200))} {items[i][1].upper()} {text(rnd.randrange(300))}") for i in range(20)]
    docs += [(200, None), (201, ""), (202, "yes, NO"), (203, "yes no maybe"), (204, text(60000)), (205, f"{text(99)} {items[34][1]} {text(70)}"),
             (206, items[3][1].split(".")[0]), (207, items[3][1]), (207, items[3][1]), (None, items[4][1])]
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as score")
    df = docs_of(spark, docs).selectExpr("*", "1 as score", "2 as item_id")
    want = brute(docs, items)
    assert {(100 + i, i) for i in range(20)} <= want and (202, 42) in want and (203, 42) not in want and (205, 44) in want
    assert pairs(D.contaminated(df, b)) == want
    assert pairs(D.contaminated(df, b, shard_bytes=500)) == want
    kept = D.decontaminated(df, b)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i is not None and i not in {a for a, _ in want})
    assert pairs(D.contaminated(df, b.limit(0))) == set() and pairs(D.contaminated(df.limit(0), b)) == set()
