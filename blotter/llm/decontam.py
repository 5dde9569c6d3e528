"""Benchmark decontamination by BM25 over an inverted index of test items.

Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. An
item's answer is its last sentence (one sentence only: the last third of its
terms), its question the rest. Every document is cut into passages of twice
the longest item's length, by half their length, so each item lies whole in a
passage. Every passage is a query over its distinct terms; all items with at
least ``RATIO`` of the score that the item has with itself are retrieved by
block-max WAND:

1. pivot: an item's cheapest terms that cannot reach its threshold together
   are passed over; only postings of its other terms bring the item up;
2. block check: the largest impacts of the item's block over the passage's
   terms must reach the threshold;
3. only then the exact BM25 score is summed.

A retrieved item counts when at least ``OVERLAP`` of the question's and of the
answer's distinct n-grams (five terms, or all of a shorter part) stand in the
passage. An item of fewer than ``SHORT`` terms is ordinary text as well, so it
matches only a document with no other terms.

The index is broadcast in shards of at most ``SHARD_BYTES`` of item text; a
larger benchmark is searched shard by shard, none is left out. Null or empty
texts and items have no terms and match nothing. Rows that share a doc_id each
give their hits; rows with a null doc_id give hits with a null doc_id; equal
items each give a hit; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .packed import distinct
from .text import flat, hash_spans, ranges, slices, window_hash, words

RATIO = 0.5
OVERLAP = 0.6
NGRAM = 5
SHORT = 5
BLOCK = 8
K1, B = 1.2, 0.75
LEAST_PASSAGE = 128
SHARD_BYTES = 4 << 20
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
HIT = "item_id long, score double, ratio double, question_overlap double, answer_overlap double, start long, end long"
_OTHER = np.ones(256, bool)
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _OTHER[ord(_a):ord(_b) + 1] = False
_OTHER[128:] = False


def terms(texts: pa.Array):
    """Per slice of documents: (first document, Words, term hashes)."""
    raw, offsets = flat(texts)
    for i, j in slices(offsets):
        w = words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower=True, sep=_OTHER)
        yield i, w, hash_spans(w.raw, w.start, w.end, seed=3)


def _hashes(text: str) -> np.ndarray:
    return next(iter(terms(pa.array([text], pa.string()))))[2]


def grams(h: np.ndarray, n: int = NGRAM) -> np.ndarray:
    return np.unique(window_hash(h, min(n, len(h)))) if len(h) else np.zeros(0, np.uint64)


class Index:
    """Inverted index of one shard of items, with block maxima."""

    def __init__(self, items: list[tuple[int, str]], count: int, df: dict[int, int], mean: float,
                 passage: int, ratio: float = RATIO):
        self.ids = [i for i, _ in items]
        self.passage = passage
        split = []
        for _, text in items:
            parts = [p for p in _SENTENCE.split(text) if len(_hashes(p))]
            whole = _hashes(text)
            if len(parts) > 1:
                a = len(_hashes(parts[-1]))
            else:
                a = -(-len(whole) // 3)
            split.append((whole, whole[:len(whole) - a], whole[len(whole) - a:]))
        order = sorted(range(len(items)), key=lambda i: (len(split[i][0]), i))  # blocks of like lengths
        self.ids = np.array([self.ids[i] for i in order], np.int64)
        split = [split[i] for i in order]
        self.whole = [s[0] for s in split]
        self.question = [grams(s[1]) for s in split]
        self.answer = [grams(s[2]) for s in split]
        self.question_n = [min(NGRAM, len(s[1])) for s in split]
        self.answer_n = [min(NGRAM, len(s[2])) for s in split]
        self.vocab = np.unique(np.concatenate([*self.whole, np.zeros(0, np.uint64)]))
        idf = np.array([np.log(1 + (count - df[int(t)] + 0.5) / (df[int(t)] + 0.5)) for t in self.vocab.tolist()])
        v = self.width = max(1, len(self.vocab))
        item, term, impact, lead = [], [], [], []
        self.limit = np.zeros(len(split))
        for i, w in enumerate(self.whole):
            t, tf = np.unique(np.searchsorted(self.vocab, w), return_counts=True)
            x = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean)) if len(w) else np.zeros(0)
            self.limit[i] = ratio * x.sum()
            cheap = np.zeros(len(x), bool)
            rank = np.argsort(x, kind="stable")
            cheap[rank] = np.cumsum(x[rank]) < self.limit[i] * (1 - 1e-9)
            item.append(np.full(len(t), i))
            term.append(t)
            impact.append(x)
            lead.append(~cheap)
        item, term = np.concatenate([*item, np.zeros(0, np.int64)]), np.concatenate([*term, np.zeros(0, np.int64)])
        impact, lead = np.concatenate([*impact, np.zeros(0)]), np.concatenate([*lead, np.zeros(0, bool)])
        self.pair = item * v + term  # sorted
        self.impact = impact
        # postings that can bring an item up, by term
        rank = np.argsort(term[lead], kind="stable")
        self.post = item[lead][rank]
        self.post_at = np.searchsorted(term[lead][rank], np.arange(v + 1))
        # per block and term the largest impact as a share of its item's limit
        share = impact / np.maximum(self.limit[item], 1e-12)
        code = (item // BLOCK) * v + term
        rank = np.argsort(code, kind="stable")
        new = np.flatnonzero(distinct(code[rank]))
        self.block_pair = code[rank][new]
        self.block_max = np.maximum.reduceat(share[rank], new) if len(new) else np.zeros(0)

    @staticmethod
    def _look(keys: np.ndarray, values: np.ndarray, ask: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(ask))
        at = np.minimum(np.searchsorted(keys, ask), len(keys) - 1)
        return np.where(keys[at] == ask, values[at], 0.0)

    def retrieve(self, w, h: np.ndarray):
        """(passage number, document, start, end, item, score) above threshold."""
        if not len(self.vocab) or not len(h):
            return []
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        term = np.where(self.vocab[at] == h, at, -1)
        step = self.passage // 2
        count = np.diff(w.first)
        n_pass = np.where(count > 0, np.maximum(1, -(-count // step) - 1), 0)
        base = np.cumsum(n_pass) - n_pass
        doc = w.doc
        place = np.arange(len(h)) - w.first[doc]
        use = np.flatnonzero(term >= 0)
        last = np.minimum(place[use] // step, n_pass[doc[use]] - 1)
        before = np.maximum(place[use] // step - 1, 0)
        p = np.concatenate([base[doc[use]] + last, (base[doc[use]] + before)[before < last]])
        t = np.concatenate([term[use], term[use][before < last]])
        bring = np.diff(self.post_at)[t] > 0
        key = np.unique(p[bring] * self.width + t[bring])
        bp, bt = key // self.width, key % self.width
        size = np.diff(self.post_at)[bt]
        pair = np.unique(np.repeat(bp, size) * len(self.ids) + self.post[ranges(self.post_at[bt], size)])
        if not len(pair):
            return []
        cp, ci = pair // len(self.ids), pair % len(self.ids)
        mask = np.zeros(int(n_pass.sum()), bool)
        mask[cp] = True
        inside = mask[p]
        key = np.unique(p[inside] * self.width + t[inside])  # distinct terms of the passages in play
        tp, tt = key // self.width, key % self.width
        first = np.searchsorted(tp, np.arange(len(mask) + 1))

        def total(keys, values, owner, passages):
            size = first[passages + 1] - first[passages]
            at = ranges(first[passages], size)
            got = self._look(keys, values, np.repeat(owner, size) * self.width + tt[at])
            return np.bincount(np.repeat(np.arange(len(passages)), size), weights=got, minlength=len(passages))

        both, which = np.unique(cp * (len(self.ids) // BLOCK + 1) + ci // BLOCK, return_inverse=True)
        blocks = len(self.ids) // BLOCK + 1
        bound = total(self.block_pair, self.block_max, both % blocks, both // blocks)
        keep = bound[which] >= 1 - 1e-9
        cp, ci = cp[keep], ci[keep]
        score = total(self.pair, self.impact, ci, cp)
        keep = score >= self.limit[ci] * (1 - 1e-9)
        out = []
        for q, i, s in zip(cp[keep].tolist(), ci[keep].tolist(), score[keep].tolist()):
            d = int(np.searchsorted(base + n_pass, q, side="right"))
            a = int(w.first[d]) + (q - int(base[d])) * step
            b = min(int(w.first[d + 1]), a + self.passage) if q - base[d] < n_pass[d] - 1 else int(w.first[d + 1])
            out.append((d, a, b, i, s))
        return out

    def verify(self, w, h, d: int, a: int, b: int, i: int) -> tuple[float, float] | None:
        """Question and answer overlap of item ``i`` in terms a..b-1."""
        if len(self.whole[i]) < SHORT:
            same = np.array_equal(h[w.first[d]:w.first[d + 1]], self.whole[i])
            return (1.0, 1.0) if same else None

        def share(part, n):
            return 1.0 if not len(part) else float(np.isin(part, window_hash(h[a:b], n)).mean())
        return share(self.question[i], self.question_n[i]), share(self.answer[i], self.answer_n[i])

    def hits(self, texts: pa.Array, overlap: float = OVERLAP) -> list[list[dict]]:
        """Per document its verified items, each by its best passage."""
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for i0, w, h in terms(texts):
            best: dict[tuple[int, int], dict] = {}
            for d, a, b, i, s in self.retrieve(w, h):
                got = self.verify(w, h, d, a, b, i)
                if got is None or min(got) < overlap:
                    continue
                hit = {"item_id": int(self.ids[i]), "score": s, "ratio": s / (self.limit[i] / RATIO),
                       "question_overlap": got[0], "answer_overlap": got[1],
                       "start": a - int(w.first[d]), "end": b - int(w.first[d])}
                old = best.get((d, i))
                if old is None or min(got) > min(old["question_overlap"], old["answer_overlap"]):
                    best[(d, i)] = hit
            for (d, _), hit in sorted(best.items()):
                out[i0 + d].append(hit)
        return out


def indexes(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES):
    """The shards of the index, one after another. Term counts are those of
    all items, so scores do not depend on the shards."""
    items = benchmark.where(F.col("item_id").isNotNull() & (F.length("text") > 0)) \
        .select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    count, longest, total, df = 0, 0, 0, {}
    for r in items.toLocalIterator():
        h = _hashes(r.text)
        count, longest, total = count + 1, max(longest, len(h)), total + len(h)
        for t in set(h.tolist()):
            df[t] = df.get(t, 0) + 1
    passage = max(LEAST_PASSAGE, 2 * longest)
    mean = max(1.0, total / max(1, count))
    shard, size = [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        shard.append((r.item_id, r.text))
        size += len(r.text.encode())
        if size >= shard_bytes:
            yield Index(shard, count, df, mean, passage)
            shard, size = [], 0
    if shard:
        yield Index(shard, count, df, mean, passage)


def _searcher(handle):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("ratio", pa.float64()),
                               ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
                               ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        index = handle.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(index.hits(b.column(0)), kind)],
                                             [*b.schema.names[1:], "_dc_hits"])
    return run


def with_hits(docs: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with ``_dc_hits``, the verified items of each; every column passes through."""
    spark = docs.sparkSession
    ship(spark)
    out = docs.withColumn("_dc_hits", F.array().cast(f"array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>"))
    for index in indexes(benchmark, shard_bytes):
        handle = spark.sparkContext.broadcast(index)
        sent = out.select(F.col("text").cast("string").alias("_dc_text"), F.struct(*[F.col(f"`{c}`") for c in out.columns]).alias("_dc_row"))
        schema = T.StructType([sent.schema["_dc_row"], T.StructField("_dc_new", out.schema["_dc_hits"].dataType)])

        def named(batches, run=_searcher(handle)):
            for b in run(batches):
                yield pa.RecordBatch.from_arrays(b.columns, ["_dc_row", "_dc_new"])
        out = sent.mapInArrow(named, schema).select("_dc_row.*", "_dc_new") \
            .withColumn("_dc_hits", F.concat("_dc_hits", "_dc_new")).drop("_dc_new")
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per (document, item): doc_id and the hit's fields; start and end
    are the passage's terms."""
    return with_hits(docs.select("doc_id", "text"), benchmark, **options) \
        .select("doc_id", F.inline("_dc_hits"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, with their columns."""
    return with_hits(docs, benchmark, **options).where(F.size("_dc_hits") == 0).select(*docs.columns)
