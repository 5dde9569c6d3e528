from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from blotter.llm import quality
from blotter.llm.catalog import QUERIES

from .conftest import SF_LARGE, SF_MID, docs_of


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, SF_MID).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(truth[i], got[i].predicted) for i in truth if got[i].held_out]
    assert np.mean([a == b for a, b in held]) >= 0.95
    assert np.mean([b for a, b in held if a == 1]) >= 0.95


def test_votes_against_brute_force():
    rnd = np.random.default_rng(1)
    rows = rnd.normal(size=(60, quality.SKETCH)).astype(np.float32)
    labels = rnd.integers(0, 2, 60)
    m = quality.Model.fit(np.ones(quality.WIDTH), rows, labels, dims=20)
    score = m.score(rows, k=7, block=16)
    x = rows @ m.basis
    for i in range(60):
        cos = [float(x[i] @ v / np.linalg.norm(x[i])) for v in m.vectors]
        top = np.argsort(cos)[-7:]
        w = np.array([max(cos[t], 1e-6) ** quality.POWER for t in top])
        assert abs(score[i] - (w * labels[top]).sum() / w.sum()) < 1e-4


def _named_terms(text):
    """(field, term) pairs by plain Python."""
    low = re.findall(r"[^ \t-\r]+", "".join(c.lower() if c.isascii() else c for c in text))
    kind = lambda c: "A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127 else "0" if "0" <= c <= "9" else c
    shape = [re.sub(r"(.)\1+", r"\1", "".join(map(kind, w))) for w in re.findall(r"[^ \t-\r]+", text)]
    return [[(w,) for w in low], list(zip(low, low[1:])), [(w,) for w in shape] + list(zip(shape, shape[1:]))]


def test_terms_and_weights_against_brute_force(spark):
    texts = ["One one TWO!! two 2024", "", None, "é\u00c9t\u00e9 one  two\n3,14", "one one one one", " \t", "AA\u00e9a x", "x"]
    idf = quality.weights(docs_of(spark, list(enumerate(texts))))
    named = [_named_terms(t or "") for t in texts]
    parts = [x for _, _, x in quality._parts(pa.array(texts))]
    doc, term, count = parts[0]
    for i, fields in enumerate(named):
        for f, got in enumerate(fields):
            mine = (doc == i) & (term // quality.VOCAB == f)
            assert sorted(count[mine]) == sorted(Counter(got).values())
            for t, c in zip(term[mine], count[mine]):
                have = [sum(1 for other in named if x in other[f]) for x, n in Counter(got).items() if n == c]
                assert any(abs(idf[t] - (np.log((1 + 5) / (1 + n)) + 0.3)) < 1e-9 for n in have)
    rows = quality.sketch(len(texts), parts[0], idf)
    assert [bool(r.any()) for r in rows] == [True, False, False, True, True, False, True, True]


def test_ablation_of_fields(spark):
    """Ablation on held-out rows: AUC of all fields, and of each field left out."""
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels.where("quality is not null").dropDuplicates(["doc_id"]), "doc_id").select("doc_id", "text", "quality").collect()
    idf = quality.weights(docs)
    held = np.array([zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows])
    truth = np.array([r.quality for r in rows])

    def auc(fields):
        parts = []
        for i, j, (doc, term, count) in quality._parts(pa.array([r.text for r in rows])):
            use = np.isin(term // quality.VOCAB, fields)
            parts.append(quality.sketch(j - i, (doc[use], term[use], count[use]), idf))
        x = np.concatenate(parts)
        score = quality.Model.fit(idf, x[~held], truth[~held]).score(x[held])
        good, bad = score[truth[held] == 1], score[truth[held] == 0]
        return ((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean()

    got = {f: auc(f) for f in ((0, 1, 2), (0, 1), (0, 2), (1, 2), (2,))}
    assert got[0, 1, 2] >= 0.98 and got[0, 1] >= 0.9


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 60000), (4, "word " * 3), (None, "A text of words."), (5, "x")]
    docs = docs_of(spark, rows).selectExpr("*", "1 as score", "2 as quality", "3 as counts")
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = quality.classify(docs, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.score for r in got}[2] == model.base
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    none = quality.train(docs, labels.limit(0))
    assert all(r.score == 1.0 for r in quality.classify(docs, none).collect())
    assert quality.classify(docs.limit(0), model).count() == 0
