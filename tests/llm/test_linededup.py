from __future__ import annotations

from blotter.llm.catalog import ORACLE, QUERIES
from blotter.llm.linededup import line_dedup
from tests.oracle_harness import compare, duck

from .conftest import SF_MID, docs_of


def test_whole_small_table_against_sql(spark):
    key = "op2_line_dedup"
    assert compare(spark, duck(SF_MID), key, QUERIES[key], ORACLE[key], SF_MID)["status"] == "match"


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a\n\nb\nc\nd"), (4, "x\na\nb\n \nc\ny"), (5, "q\nq\nq\nq\nq"), (6, "line\n" * 30000 + "end"), (7, "b\nc\nd"),
            (7, "b\nc\nd"), (None, "a\nb\nc"), (8, "a\nb")]
    docs = docs_of(spark, rows).selectExpr("*", "1 as pos", "2 as h1", "3 as n_lines2")
    out = line_dedup(docs, counts=True)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)
    want = sorted([(1, None, 0, 0), (2, "", 0, 0), (3, "a\n\nb\nc\nd", 4, 0), (4, "x\n \ny", 5, 3), (5, "q", 5, 4), (6, "line\nline\nend", 30001, 29998),
                   (7, "", 3, 3), (7, "", 3, 3), (None, "a\nb\nc", 3, 0), (8, "a\nb", 2, 0)], key=str)
    assert [w for w in want if w[0] != 6] == [g for g in got if g[0] != 6]
    assert next(g for g in got if g[0] == 6)[2] == 30001
    assert line_dedup(docs).columns == docs.columns and line_dedup(docs.limit(0)).count() == 0
