from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from blotter.llm import tokenfile as t
from blotter.llm.catalog import QUERIES

from .conftest import SF_MID, docs_of


def expected(rows):
    tok = Tokenizer.from_file(t.default_path())
    out, start = [], 0
    for i, text in sorted(((i, x or "") for i, x in rows if i is not None)):
        ids = tok.encode(text, add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_small_table_against_the_tokenizer(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op8_token_output"](spark, SF_MID).collect()) == expected(rows)


def round_trip(spark, docs):
    folder = t.output_folder(spark)
    t.write(docs, folder)
    got = t.positions(t.read(spark, folder), folder).collect()
    return sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\x0b\x1c\x85 "), (5, "Don't  STOP it's é́ <|endoftext|> x<|endoftext|>.. <|startoftext|>a <|ENDOFTEXT|> ÀÉ K ﬁ"), (5, "b"), (7, "word " * 70000),
            (8, "x" * 5000), (None, "none"), (-4, "first　漢字 \U0001F600"), (9, "a b​c\x1fd")]
    docs = docs_of(spark, rows).selectExpr("*", "1 as ids", "2 as shard", "3 as start")
    assert round_trip(spark, docs) == expected(rows)
    many = rows + [(1000 + i, f"{'Word, ' * 9000}{i}.") for i in range(150)]  # several cells, one long document
    many += [(5000, "long " * 1200000)]
    assert round_trip(spark, docs_of(spark, many).coalesce(1)) == expected(many)
    assert round_trip(spark, docs.limit(0)) == []


@pytest.mark.parametrize("n", [1, 7, 8, 9, 1000, 200000])
def test_coder_round_trip(n):
    rnd = np.random.default_rng(n)
    ids = np.minimum(rnd.zipf(1.3, n), 49407).astype(np.int64)
    freq = t.scaled(np.bincount(ids))
    assert freq.sum() == 1 << t.SCALE and (freq[ids] > 0).all()
    lens = np.array([n // 2, n - n // 2])
    lens = lens[lens > 0]
    coded = t.rans_encode(ids, freq, lens)
    assert np.array_equal(t.rans_decode([p for p, _ in coded], [s for _, s in coded], lens, freq), ids)


def test_many_ids_that_occur_once():
    counts = np.ones(50000, np.int64)
    counts[7] = 10 ** 9
    freq = t.scaled(counts)
    assert freq.sum() == 1 << t.SCALE and freq.min() == 1


def test_damage_is_found(spark):
    folder = t.output_folder(spark)
    t.write(docs_of(spark, [(1, "some words here " * 50)]), folder)
    bad = t.output_folder(spark)
    spark.read.parquet(folder).selectExpr("shard", "cell", "table", "lens", "payloads", "states", "transform(crcs, x -> x + 1) as crcs", "docs", "counts") \
        .write.parquet(bad)
    with pytest.raises(Exception, match="checksum"):
        t.read(spark, bad).collect()


def test_words_of_letters_are_learned_together():
    """Texts of letters go to the library without a special token between them;
    letters that it takes apart, and marks after letters of Latin-1, come out as it gives them."""
    library = Tokenizer.from_file(t.default_path())

    def ids(encoder, texts):
        return [i for body, _ in encoder.encode(pa.array(texts)) for i in body.tolist()]

    def plainly(texts):
        return [i for text in texts for i in [*library.encode(text, add_special_tokens=False).ids, t.END]]
    encoder, marked = t.Encoder(t.default_path()), []
    inner = encoder._ids
    encoder._ids = lambda texts, joined: marked.extend(texts) or inner(texts, joined)
    texts = ["Plain words, osé. canción; único! straße", "ΣΊΣΥΦΟΣ 한국어 文字 ﬁn ŉ"]
    assert ids(encoder, texts) == plainly(texts)
    assert sorted(marked) == ["!", ",", ".", ";"]
    odd = ["İstanbul İ क़अ été. ×. 5×, a÷! ½. don't l'été's é's é|> ª. µ, x² été'", "<|endoftext|> Été. osé|>"]
    odd += [chr(c) + " " + chr(c) + "." for c in range(0xA1, 0x250)] + [chr(c) * 2 for c in range(0x900, 0x980)]
    for part in (odd, odd[:1], odd[2:]):
        assert ids(encoder, part) == plainly(part)
        assert ids(t.Encoder(t.default_path()), part) == plainly(part)


def test_words_of_a_to_z_need_no_normalizer():
    encoder = t.Encoder(t.default_path())
    words = ["don", "s", "t", "re", "ve", "abcdefghijklmnopqrstuvwxyz", "supercalifragilistic", *[chr(c) for c in range(97, 123)],
             *[chr(a) + chr(b) for a in range(97, 123) for b in range(97, 123)]] * 2
    got, sizes = encoder._ascii(words, True)
    each = [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert got.tolist() == [i for ids in each for i in ids]
    assert sizes.tolist() == [len(ids) for ids in each]
