from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from blotter.llm import spelling as s
from blotter.llm.catalog import ORACLE, QUERIES
from tests.oracle_harness import compare, duck

from .conftest import SF_MID, docs_of


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    n = {w: c for w, c in found.items() if len(w) >= 6 and c >= 5}
    others = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, around in others.items():
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n.get(form[w])))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_whole_small_table_against_sql(spark):
    key = "op13_spelling_variants"
    r = compare(spark, duck(SF_MID), key, QUERIES[key], ORACLE[key], SF_MID)
    assert r["status"] == "match" and "types" not in r and r["rows"] > 1000, r


def corpus():
    rnd = random.Random(9)
    stems = ["".join(rnd.choice("abcÀéÿ×÷z") for _ in range(rnd.randrange(5, 9))) for _ in range(60)]
    words = []
    for w in stems:  # neighbourhoods of one and two edits, popular and rare
        for _ in range(8):
            at, c = rnd.randrange(len(w)), rnd.choice("abzÿ÷")
            words += [rnd.choice([w[:at] + c + w[at:], w[:at] + w[at + 1:], w[:at] + c + w[at + 1:], w])] * rnd.choice([1, 5, 6, 30, 160])
    words += ["x" * 300] * 5 + ["x" * 299 + "y"] * 30 + ["x" * 301] * 160 + ["ABCABC"] * 5 + ["abcabcÉ"] * 5 + ["abcabcé"] * 25
    rnd.shuffle(words)
    return [(i, rnd.choice([" ", "9", "-", "\n"]).join(words[i::40])) for i in range(40)] + [(1, None), (2, ""), (1, "short w"), (None, "nobody " * 6), (None, "no")]


@pytest.mark.parametrize("load", [1, 200, s.LOAD])
def test_against_all_pairs(spark, load):
    """Also with all or some of the top's subtrees dealt on to the subtrees below."""
    rows = corpus()
    docs = docs_of(spark, rows).selectExpr("*", "1 as n", "'a' as word", "2 as bin").repartition(3)
    assert got(s.spelling_groups(docs, load)) == brute(rows)


def test_flushed_counters(spark, monkeypatch):
    rows = corpus()
    whole = Counter()
    for i, text in rows:
        whole.update(w for w in s._words_of(i, text or "") if len(w) >= 6)
    monkeypatch.setattr(s, "COUNTED", 3)
    import pyarrow as pa
    parts = Counter()
    for b in s._count([pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["doc_id", "text"])]):
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            parts[w] += n
    assert parts == whole


def test_no_words(spark):
    assert got(s.spelling_groups(docs_of(spark, [(1, "a")]).limit(0))) == []
    assert got(s.spelling_groups(docs_of(spark, [(1, "a lonely word")]))) == []
