"""Quality classifier: nearest-neighbour voting on latent-semantic vectors.

A document's terms are its lower-cased words, its pairs of words, and the
shapes of its words (upper case, lower case and digits as one letter each,
runs of one letter once) with their pairs, hashed into ``VOCAB`` terms a field.
Terms weigh sublinear counts times idf, the idf from all documents; every field
has length 1. A signed sketch of ``SKETCH`` columns bounds the matrix, and a
truncated SVD of the labelled sample's sketch gives the latent space.
The labelled vectors (at most ``TRAIN`` rows of ``DIMS`` floats, a proven
bound) are broadcast; every document's cosine with all of them is an exact
blocked product, and its ``K`` nearest vote with weights that grow with the
similarity.

Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not 2,
at most ``TRAIN`` of them, taken by a hash of doc_id. No label, lang, source or
doc_id enters a score. Null and empty texts and texts without words score the
sample's share of label 1. Without labelled rows every score is 1.0 (nothing is
learned, nothing is rejected). Rows that share a doc_id each give a row; a null
doc_id gives a row that is not held out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .text import Words, flat, hash_spans, slices, window_hash, window_starts, words

TRAIN = 4000
VOCAB = 1 << 16
FIELDS = 3  # words, pairs of words, shapes
WIDTH = FIELDS * VOCAB
SKETCH = 1024
DIMS = 64
K = 15
POWER = 8
ACCEPT = 0.7
BLOCK = 1024  # documents held as sketches at once
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[ord("0"):ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")
_COLUMN = np.random.default_rng(3).integers(0, SKETCH, WIDTH)
_SIGN = np.random.default_rng(4).choice(np.array([-1.0, 1.0]), WIDTH)


def _shapes(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """The words written by class of character, runs of one class once."""
    kinds = _CLASS[raw]
    kept = np.ones(len(kinds), bool)
    kept[1:] = kinds[1:] != kinds[:-1]
    kept[offsets[:-1][np.diff(offsets) > 0]] = True
    return words(kinds[kept], np.concatenate([[0], np.cumsum(kept)])[offsets])


def terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count), by document and term; a term holds its field."""
    keys = []
    for w, single, pair in ((words(raw, offsets, lower=True), 0, 1), (_shapes(raw, offsets), 2, 2)):
        h = hash_spans(w.raw, w.start, w.end, seed=11)
        doc, inside = w.doc, window_starts(w.first, 2, len(h) - 1)
        for d, x, field in ((doc, h, single), (doc[:-1][inside], window_hash(h, 2)[inside], pair)):
            keys.append(d * WIDTH + field * VOCAB + (x % np.uint64(VOCAB)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // WIDTH, key % WIDTH, count


def _parts(texts: pa.Array) -> Iterator[tuple[int, int, tuple]]:
    """(first, end, terms) of runs of at most BLOCK documents."""
    raw, offsets = flat(texts)
    for i, j in slices(offsets):
        for a in range(i, j, BLOCK):
            z = min(a + BLOCK, j)
            yield a, z, terms(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a])


def sketch(n: int, parts: tuple, idf: np.ndarray) -> np.ndarray:
    """n weighted rows of SKETCH columns; zero without terms."""
    doc, term, count = parts
    w = np.log1p(count) * idf[term]
    field = doc * FIELDS + term // VOCAB
    w /= np.sqrt(np.bincount(field, w * w, minlength=n * FIELDS))[field]
    rows = np.bincount(doc * SKETCH + _COLUMN[term], w * _SIGN[term], minlength=n * SKETCH)
    return rows.reshape(n, SKETCH).astype(np.float32)


class Model:
    """Term weights, latent space, labelled vectors and labels; scores blocks of documents."""

    def __init__(self, idf, basis, vectors, labels):
        self.idf, self.basis, self.vectors, self.labels = idf, basis, vectors, labels
        self.base = float(labels.mean()) if len(labels) else 1.0

    @classmethod
    def fit(cls, idf: np.ndarray, rows: np.ndarray, labels: np.ndarray, dims: int = DIMS) -> Model:
        full = rows.any(axis=1)
        x, labels = rows[full].astype(np.float64), labels[full].astype(np.float64)
        if not len(labels):
            return cls(idf, np.zeros((SKETCH, 1), np.float32), np.zeros((0, 1), np.float32), labels)
        _, vec = np.linalg.eigh(x.T @ x)
        basis = vec[:, ::-1][:, :dims]
        basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])] < 0, -1, 1)
        return cls(idf, basis.astype(np.float32), cls.unit((x @ basis).astype(np.float32)), labels)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, rows: np.ndarray, k: int = K, power: float = POWER, block: int = 512) -> np.ndarray:
        out = np.full(len(rows), self.base)
        if not len(self.labels):
            return out
        full = np.flatnonzero(rows.any(axis=1))
        k = min(k, len(self.labels))
        for i in range(0, len(full), block):
            at = full[i:i + block]
            cos = self.unit(rows[at] @ self.basis) @ self.vectors.T
            top = np.argpartition(cos, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cos, top, axis=1), 1e-6).astype(np.float64) ** power
            out[at] = (weight * self.labels[top]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def held_out(doc_id: str) -> Column:
    """crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _frequencies(batches):
    """(term, documents with it) of a task; term -1 counts documents with words."""
    seen = np.zeros(WIDTH + 1, np.int64)
    for b in batches:
        for _, _, (doc, term, _) in _parts(b.column(0)):
            seen[1:] += np.bincount(term, minlength=WIDTH)
            seen[0] += np.count_nonzero(np.diff(doc, prepend=-1))
    term = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(term - 1, pa.int32()), pa.array(seen[term], pa.int64())], ["term", "n"])


def weights(documents: DataFrame) -> np.ndarray:
    """idf of every term over all documents (at most WIDTH + 1 rows reach the driver)."""
    ship(documents.sparkSession)
    got = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequencies, "term int, n long") \
        .groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(WIDTH + 1)
    seen[got.column("term").to_numpy() + 1] = got.column("n").to_numpy()
    return np.log((1 + seen[0]) / (1 + seen[1:])) + 0.3


def _sketches(handle):
    def run(batches):
        idf = handle.value
        for b in batches:
            rows = [r.tobytes() for i, j, t in _parts(b.column(0)) for r in sketch(j - i, t, idf)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), b.column(1), b.column(2)], ["row", "quality", "doc_id"])
    return run


def train(documents: DataFrame, labels: DataFrame, limit: int = TRAIN) -> Model:
    """The model of at most ``limit`` labelled documents, its term weights from all documents."""
    spark = documents.sparkSession
    idf = weights(documents)
    chosen = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id")) \
        .select("doc_id", F.col("quality").cast("int").alias("quality")).distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(limit)
    got = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id") \
        .select(F.col("text").cast("string").alias("text"), "quality", F.col("doc_id").cast("long").alias("doc_id")) \
        .mapInArrow(_sketches(spark.sparkContext.broadcast(idf)), "row binary, quality int, doc_id long") \
        .orderBy("doc_id", "quality", "row").limit(limit).collect()
    rows = np.array([np.frombuffer(r.row, np.float32) for r in got]).reshape(-1, SKETCH)
    return Model.fit(idf, rows, np.array([r.quality for r in got]))


def _scorer(handle):
    def run(batches):
        model = handle.value
        for b in batches:
            parts = [model.score(sketch(j - i, t, model.idf)) for i, j, t in _parts(b.column(0))]
            score = pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], score], [*b.schema.names[1:], "_q_score"])
    return run


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_q_score``; every column passes through."""
    spark = docs.sparkSession
    ship(spark)
    handle = spark.sparkContext.broadcast(model)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_q_row")
    sent = docs.select(F.col("text").cast("string").alias("_q_text"), whole)
    schema = T.StructType([sent.schema["_q_row"], T.StructField("_q_score", T.DoubleType())])
    out = sent.mapInArrow(_scorer(handle), schema)
    return out.select("_q_row.*", "_q_score")


def classify(documents: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    return with_score(documents.select("doc_id", "text"), model) \
        .select("doc_id", held_out("doc_id").alias("held_out"), F.col("_q_score").alias("score"),
                (F.col("_q_score") >= accept).cast("int").alias("predicted"))


def accepted(documents: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The documents that are not rejected, with their columns. A text without
    words has nothing to reject and stays, whatever the model's prior."""
    wordless = ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return with_score(documents, model).where((F.col("_q_score") >= accept) | wordless).select(*documents.columns)
