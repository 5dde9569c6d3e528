from __future__ import annotations

import hashlib
import random
import re

from blotter.llm.catalog import QUERIES
from blotter.llm.substring import substring_dedup

from .conftest import SF_MID, docs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k=50):
    least, split = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - k + 1):
            x = " ".join(w[s:s + k])
            least[x] = min(least.get(x, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            if least[" ".join(w[s:s + k])] < i:
                gone[s:s + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def digest(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect())


def test_whole_small_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op3_substring_dedup"](spark, SF_MID).collect())
    assert got == brute(rows)


def test_planted_passages_and_edge_cases(spark):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(10 ** 6)}"
    passage = [word() for _ in range(90)]
    rows = [(100, None), (101, ""), (102, " \n"), (103, "é " * 30)]
    for i in range(20):
        a, n = rnd.randrange(40), rnd.randrange(40, 60)
        rows.append((i, " ".join([word() for _ in range(rnd.randrange(80))] + passage[a:a + n]
                                 + [word() for _ in range(rnd.randrange(80))])))
    rows += [(200, "x " * 60), (201, "x " * 200), (202, "y\tx " * 30000), (203, "x " * 49), (204, "x " * 50)]
    rows += [(300 + i, rows[6][1]) for i in range(5)] + [(-5, rows[9][1])]
    got = substring_dedup(docs_of(spark, rows))
    assert digest(got) == brute(rows)
    for r in got.collect():
        assert sum(x.end - x.start for x in r.removed) == r.n_removed
    assert digest(substring_dedup(docs_of(spark, []))) == []
    clash = docs_of(spark, rows + [(None, "x " * 60)]).selectExpr("*", "1 as chunk", "2 as bucket", "3 as payload")
    assert digest(substring_dedup(clash)) == brute(rows)


def test_repeated_rows_do_not_remove_each_other(spark):
    t = " ".join(f"a{i}" for i in range(70))
    rows = [(1, t), (1, t + " b"), (2, t)]
    assert [(i, n, g) for i, n, g, _ in digest(substring_dedup(docs_of(spark, rows)))] == [(1, 70, 0), (1, 71, 0), (2, 70, 70)]


def test_a_copy_is_a_row_not_a_doc_id(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    got = substring_dedup(docs_of(spark, [(1, a), (5, a), (5, b)])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted([(1, 60, 0, a), (5, 60, 60, ""), (5, 60, 0, b)])
