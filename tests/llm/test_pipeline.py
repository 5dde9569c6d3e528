from __future__ import annotations

import sentencepiece

import corpus_pipeline as P
from blotter.llm import quality
from blotter.llm.pieces import default_path

from .conftest import docs_of
from .test_decontam import brute as leaks
from .test_jaccard import brute as groups

SMALL = "/root/testdata/sf0.001"


def dedup_lines(rows):
    seen, out = set(), []
    for i, text in sorted(rows):
        raw = text.split("\n")
        full = [k for k, x in enumerate(raw) if x.strip(" ")]
        gone = set()
        for p in range(len(full) - 2):
            w = tuple(raw[k] for k in full[p:p + 3])
            if w in seen:
                gone.update(full[p:p + 3])
            seen.add(w)
        if not full or len(gone) < len(full):
            out.append((i, "\n".join(x for k, x in enumerate(raw) if k not in gone)))
    return out


def brute(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    good = {r.doc_id for r in quality.classify(docs, model).where("predicted = 1").collect()}
    good |= {r.doc_id for r in docs.collect() if not (r.text or "").strip(" \t\n\v\f\r")}
    rows = dedup_lines([(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good])
    comp = groups(rows)
    rows = [(i, t) for i, t in rows if comp[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    bad = {i for i, _ in leaks(rows, items)}
    lib = sentencepiece.SentencePieceProcessor(model_file=default_path())
    return sorted((i, t, len(t), lib.encode(t)) for i, t in rows if i not in bad)


def test_run_against_brute_force(spark):
    got = P.run(spark, SMALL)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"]
    rows = sorted((r.doc_id, r.text, r.n_chars, list(r.ids)) for r in got.collect())
    assert rows == brute(spark, SMALL) and len(rows) > 50


def test_stages_on_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "one\ntwo\nthree"), (4, "one\ntwo\nthree"), (5, "one\ntwo\nthree\nfour is new"), (5, "x"), (None, "no id"),
            (6, "word " * 30000)]
    docs = docs_of(spark, rows).selectExpr("*", "1 as score", "2 as ids2", "3 as `_x`")
    for name, stage in P.STAGES:
        out = stage(spark, docs, SMALL)
        assert out.columns[:len(docs.columns)] == docs.columns, name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
        out.collect()
    kept = {r.doc_id: r.text for r in P.lines(spark, docs.where("doc_id < 6"), SMALL).where("text is null or text != 'x'").collect()}
    assert kept == {1: None, 2: "", 3: "one\ntwo\nthree", 5: "four is new"}
    from pyspark.sql import functions as F
    assert P.lines(spark, docs, SMALL).where(F.col("doc_id").isNull()).count() == 1
    assert P.near_duplicates(spark, docs, SMALL).where(F.col("doc_id").isNull()).count() == 1


def test_wordless_texts_pass_at_any_share(spark):
    docs = docs_of(spark, [(i, f"good words number {i} stand here") for i in range(40)] + [(100, None), (101, ""), (102, " \n\t"), (103, "bad")])
    labels = spark.createDataFrame([(i, i % 10 == 0, 0) for i in range(40)], "doc_id long, quality boolean, toxic int") \
        .selectExpr("doc_id", "cast(quality as int) as quality", "toxic")
    model = quality.train(docs, labels)
    assert {100, 101, 102} <= {r.doc_id for r in quality.accepted(docs, model).collect()}
    shared = docs_of(spark, [(1, "a b c d e f g"), (5, "a b c d e f g"), (5, "h i j k l m n")])
    assert sorted((r.doc_id, r.text[0]) for r in P.near_duplicates(spark, shared, SMALL).collect()) == [(1, "a"), (5, "h")]
