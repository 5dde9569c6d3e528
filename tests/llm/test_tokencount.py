from __future__ import annotations

import numpy as np
import pytest
import sentencepiece

from blotter.llm import tokencount as t
from blotter.llm.catalog import QUERIES

from .conftest import SF_MID, docs_of

LIB = sentencepiece.SentencePieceProcessor(model_file=t.default_path())
ODD = ["", " ", "  ", "a", " a", "a ", "a  b   c ", "\n", "\n\nx\n", "0123 45", "▁▁x▁", "a▁b", "<s>x</s><unk>", "é́ ﬁ 漢字漢字 \U0001F600", "\x00\x01 a\x00b",
       "\t\tx\r\n y", "　x", "x" * 30, "word " * 3, "﷽ é", "it's 3.14%", "....----====", "[INST] <0x0A>"]


def expected(rows, limit=t.LIMIT):
    out = []
    for i, text in rows:
        n = len(LIB.encode(text or ""))
        out.append((i, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_small_table_against_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    assert got(QUERIES["op11_token_counts"](spark, SF_MID)) == expected(rows)


@pytest.mark.parametrize("keep", [1, 50, t.TABLE])
def test_edge_cases_do_not_depend_on_the_table(spark, keep):
    rows = list(enumerate(ODD)) + [(100, None), (100, "twice"), (None, "no id"), (101, "long " * 200_000), (102, "x" * 100_000), (101, "long " * 3)]
    docs = docs_of(spark, rows).selectExpr("*", "1 as part", "2 as n", "'x' as words").repartition(3)
    assert got(t.count_tokens(docs, keep=keep)) == expected(rows)
    assert got(t.count_tokens(docs, limit=1, keep=keep)) == expected(rows, 1)


def test_empty_table(spark):
    assert got(t.count_tokens(docs_of(spark, [(1, "a")]).limit(0))) == []


def test_slices_end_with_pretokens():
    lib = t.library(t.default_path())
    import pyarrow as pa
    raw, offsets = t.marked(pa.array(["aaa bb\ncc  dd" * 9, "", "x" * 100, None, "7 7"]))
    whole = [tuple(map(int, (a + s, a + e))) for a, start, end, _ in t.pretokens(raw, offsets, lib.alone) for s, e in zip(start, end)]
    small = [tuple(map(int, (a + s, a + e))) for a, start, end, _ in t.pretokens(raw, offsets, lib.alone, 8) for s, e in zip(start, end)]
    assert whole == small and whole[0][0] == 0 and all(x[1] == y[0] for x, y in zip(whole, whole[1:])) and whole[-1][1] == len(raw)


def test_summaries_keep_what_is_frequent(spark):
    """More than 1 of ``keep`` pre-tokens: kept, in whatever order the texts come."""
    rare = [(i, f"r{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}x often") for i in range(2000)]
    table = t.frequent(docs_of(spark, rare).repartition(40), t.default_path(), keep=8)
    assert b" often" in {w.tobytes()[:s] for w, s in zip(table.words.astype("<u8"), table.size.tolist())} and len(table.size) <= 8


def test_table_compares_bytes():
    a = np.frombuffer(b"ab\0\0abab\0", np.uint8)
    words, size = t.packed(a, np.array([0, 0, 4]), np.array([2, 3, 6]))
    table = t.Lengths(words[:1], size[:1], np.array([7]))
    assert table.get(words, size).tolist() == [7, -1, 7]
