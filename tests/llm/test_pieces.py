from __future__ import annotations

import random

import pyarrow as pa
import pytest
import sentencepiece

from blotter.llm import pieces

from .conftest import SF_MID, docs_of


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def ids_of(texts):
    ids, offsets = pieces.Pieces(pieces.default_path()).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_whole_small_table_equals_the_library(spark, library):
    rows = pieces.decode(pieces.encode(spark.read.parquet(f"{SF_MID}/documents.parquet")), out="back").collect()
    want = library.encode([r.text for r in rows])
    assert all(r.ids == w for r, w in zip(rows, want)) and all(r.back == r.text for r in rows)


def test_odd_texts_equal_the_library(library):
    rnd = random.Random(4)
    odd = ["", " ", "   ", "a", " a  b   c ", "\n\n\tab\r\n x", "naïve café ﬁ 　x y", "\U0001F600\U0001F680 ok 漢字カナ",
           "x" * 300, "=" * 70 + "  " * 40, "if (a==b) { return c[i++]; }", "\u0000\u0007​", "é́́ " * 9]
    alphabet = "abcdeths  \n\té漢=-_{}()0123456789ABC"
    odd += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 120))) for _ in range(400)]
    got = ids_of(odd)
    for t, ids in zip(odd, got):
        assert ids == library.encode(t), repr(t)


def test_any_ids_decode_as_in_the_library(library):
    """Sequences that begin within a word, with control or byte pieces, or with several spaces."""
    model, rnd = pieces.Pieces(pieces.default_path()), random.Random(6)
    o, space, world = (library.piece_to_id(p) for p in ("o", "▁", "▁world"))
    lists = [[o, world], [world, o], [1, world], [1, o], [space, world], [space], [], [35], [35, o], [1, 2], [2, space, space, o]]
    lists += [[rnd.randrange(3, 300 if k % 3 else library.get_piece_size()) for _ in range(rnd.randrange(9))] for k in range(300)]
    flat, offsets = [i for x in lists for i in x], [0]
    for x in lists:
        offsets.append(offsets[-1] + len(x))
    got = model.decode(pieces.np.array(flat, pieces.np.int64), pieces.np.array(offsets))
    for x, text in zip(lists, got):
        want = library.decode(x)
        assert text == want or "\ufffd" in want, (x, text, want)  # broken UTF-8 is replaced byte by byte or not
    for bad in ([-1], [library.get_piece_size()]):
        with pytest.raises(ValueError):
            model.decode(pieces.np.array(bad), pieces.np.array([0, 1]))
    with pytest.raises(ValueError):
        pieces._texts(model, pa.array([[o, None]], pa.list_(pa.int32())))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a▁b"), (3, "a▁b"), (None, "x y"), (4, "long " * 40000), (5, "z" * 20000)]
    docs = docs_of(spark, rows).selectExpr("*", "1 as decoded", "2 as `a b`")
    out = pieces.decode(pieces.encode(docs), out="back")
    assert out.columns == [*docs.columns, "ids", "back"]
    got = sorted(((r.doc_id, r.text, r.ids is None, r.back) for r in out.collect()), key=str)
    want = sorted(((i, t, t is None, t.replace("▁", " ") if t else t) for i, t in rows), key=str)
    assert got == want
    both = pieces.encode_decode(docs, back="back")
    assert sorted(((r.doc_id, r.text, r.ids is None, r.back) for r in both.collect()), key=str) == want
    assert pieces.encode(docs.limit(0)).count() == 0
