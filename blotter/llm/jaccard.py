"""N-gram Jaccard join: documents whose word shingles overlap.

A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, and a
document's set holds its distinct five-word shingles (fewer words: the whole
sequence as one; no words or null text: empty, linked with nothing). Documents
link when 100 * intersection >= 75 * union.

1. Exact copies stand for their first document.
2. A packed exchange counts in how many documents each shingle occurs. That
   gives the global order (rare shingles first), and shingles of one document
   only can be left out: a document that has less than 75 % shared ones links
   with nothing.
3. Documents that share a shingle of their prefixes (the n - ceil(0.75 n) + 1
   first in the global order) fall into one block; no linked pair is split.
4. Each block is joined in a prefix tree (``trie.links``). A block of more
   than ``BLOCK`` documents is dealt out over several trees that share a few
   pivot documents; what the pivots do not tie to the block's largest
   component is then asked against all its trees. So no pair is lost, and a
   large group of near copies never makes all its pairs.
5. Links form components.

Rows with a null ``doc_id`` are left out of the result. Rows that share a
``doc_id`` each give a row; with the same text they are one document, with
different texts they are documents of their own (``vertices``), linked or not
each by its text. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, components, copies_of, cut, ints, layout, shuffle_partitions, ship, with_chunk
from .packed import ROW, answers, bucket_edges, distinct, rows
from .text import flat, hash_spans, slices, window_hash, window_starts, words

WORDS = 5
NUM, DEN = 75, 100
BLOCK = 512
PIVOTS = 16
_LOW56 = np.uint64((1 << 56) - 1)


def shingles(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every document's distinct shingles, by hash
    and then document."""
    raw, offsets = flat(texts)
    hashes, owners = [], []
    for i, j in slices(offsets):
        w = words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower=True)
        h = hash_spans(w.raw, w.start, w.end)
        win = window_hash(h, size)
        ok = window_starts(w.first, size, len(win))
        hashes.append(win[ok])
        owners.append(w.doc[:len(win)][ok] + i)
        count = np.diff(w.first)
        for k in range(1, size):  # fewer words: the whole sequence
            docs = np.flatnonzero(count == k)
            if len(docs):
                hashes.append(window_hash(h, k)[w.first[docs]])
                owners.append(docs + i)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    d = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.lexsort((d, h))
    h, d = h[order], d[order]
    first = distinct(h)
    first[1:] |= d[1:] != d[:-1]
    return h[first], d[first]


def _kept(docs: pa.Table, side: pa.Table) -> pa.Table:
    """The chunk's rows that are not copies of an earlier document."""
    bucket, ref = side.column("bucket").to_pylist(), side.column("ref").to_pylist()
    drop = {r for b, r in zip(bucket, ref) if b == -1}
    ids = ints(docs, "doc_id")
    keep = np.array([x not in drop for x in ids.tolist()], dtype=bool)
    order = np.argsort(ids, kind="stable")
    return docs.take(pa.array(order[keep[order]]))


def _counter(size: int, buckets: int):
    def send(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return rows(0, [])
        chunk = docs.column("chunk")[0].as_py()
        h, _ = shingles(column(_kept(docs, side), "text"), size)
        first = np.flatnonzero(distinct(h))
        count = np.diff(np.append(first, len(h)))
        keys = h[first]
        edges = bucket_edges(keys, buckets)
        out = []
        for b in range(buckets):
            lo, hi = edges[b], edges[b + 1]
            if hi > lo:
                many = np.flatnonzero(count[lo:hi] > 1)
                out.append((b, b"".join([np.array([hi - lo], "<u4").tobytes(), keys[lo:hi].astype("<u4").tobytes(),
                                         many.astype("<u4").tobytes(), count[lo:hi][many].astype("<u4").tobytes()])))
        return rows(chunk, out)
    return send


def _count(table: pa.Table) -> pa.Table:
    """A bucket's document counts, as one class byte per entry (0: one document)."""
    payload = [np.frombuffer(p, "<u4") for p in table.column("payload").to_pylist()]
    keys, counts = [], []
    for p in payload:
        n = int(p[0])
        c = np.ones(n, np.int64)
        many = (len(p) - 1 - n) // 2
        c[p[1 + n:1 + n + many]] = p[1 + n + many:]
        keys.append(p[1:1 + n])
        counts.append(c)
    sizes = [len(k) for k in keys]
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(counts))
    cls = np.where(total > 1, np.minimum(255, 1 + np.floor(4 * np.log2(np.maximum(total, 1)))), 0).astype(np.uint8)
    each = np.split(cls[inverse], np.cumsum(sizes)[:-1])
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "ref": table.column("ref"),
                     "payload": pa.array([e.tobytes() for e in each], pa.binary())})


def _builder(size: int, num: int, den: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("keys", pa.binary())])

    def build(key, docs: pa.Table, side: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return schema.empty_table()
        docs = _kept(docs, side)
        h, d = shingles(column(docs, "text"), size)
        first = distinct(h)
        cls = answers(side, np.uint8)[np.cumsum(first) - 1] if len(h) else np.zeros(0, np.uint8)
        n = np.bincount(d, minlength=docs.num_rows)
        shared = np.bincount(d[cls > 0], minlength=docs.num_rows)
        live = (shared > 0) & (den * shared >= num * n)
        use = live[d] & (cls > 0)
        key_ = (cls[use].astype(np.uint64) << np.uint64(56)) | (h[use] & _LOW56)
        owner = d[use]
        order = np.lexsort((key_, owner))
        key_, owner = key_[order], owner[order]
        at = np.searchsorted(owner, np.arange(docs.num_rows + 1))
        keys = [key_[at[i]:at[i + 1]].tobytes() if live[i] else None for i in range(docs.num_rows)]
        return pa.table([column(docs, "doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary())],
                        schema=schema)
    return build


def _prefixes(num: int, den: int):
    def run(batches):
        for b in batches:
            token, doc = [], []
            for i, n, keys in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                k = np.frombuffer(keys, "<u8")
                size = n + 1 - -(-num * n // den) - (n - len(k))
                token.append(k[:size])
                doc.append(np.full(min(size, len(k)), i))
            if token:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token).view(np.int64), pa.int64()),
                                                  pa.array(np.concatenate(doc), pa.int64())], ["token", "doc_id"])
    return run


def _joiner(num: int, den: int):
    from .trie import links

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def join(table: pa.Table) -> pa.Table:
        block, ids, sizes = ints(table, "block"), ints(table, "doc_id"), ints(table, "n")
        ask = ints(table, "ask")
        keys = column(table, "keys").to_pylist()
        order = np.lexsort((ids, block))
        a, b = [], []
        for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            sets = [np.frombuffer(keys[i], "<u8") for i in part]
            u = links(sets, sizes[part], num, den, np.flatnonzero(ask[part]))
            for i in range(len(part)):
                r = u.find(i)
                if r != i and ids[part[r]] != ids[part[i]]:
                    a.append(ids[part[i]])
                    b.append(ids[part[r]])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)
    return join


def sets(docs: DataFrame, copies: DataFrame, size: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n, keys) of every document that is no copy: set size, and the
    ordered shared shingles of those that may link."""
    spark = docs.sparkSession
    ship(spark)
    chunks, buckets = layout(spark, docs.count())
    base = with_chunk(docs.select("doc_id", "text"), "doc_id", chunks)
    dropped = with_chunk(copies, "doc_id", chunks).select(
        "chunk", F.lit(-1).alias("bucket"), F.col("doc_id").alias("ref"), F.lit(None).cast("binary").alias("payload"))
    sent = base.groupBy("chunk").cogroup(dropped.groupBy("chunk")).applyInArrow(_counter(size, buckets), ROW)
    replies = sent.groupBy("bucket").applyInArrow(_count, ROW)
    side = dropped.unionByName(replies)
    return base.groupBy("chunk").cogroup(side.groupBy("chunk")) \
        .applyInArrow(_builder(size, num, den), "doc_id long, n long, keys binary")


def _edges(live: DataFrame, num: int, den: int, block_size: int) -> DataFrame:
    """Links (a, b) that tie every component of ``live`` (doc_id, n, keys)."""
    spark = live.sparkSession
    prefix = live.mapInArrow(_prefixes(num, den), "token long, doc_id long")
    groups = cut(prefix.groupBy("token").agg(F.min("doc_id").alias("m"), F.count(F.lit(1)).alias("c"))
                 .where("c > 1").select("token", "m"), "tokens")
    near = prefix.join(groups, "token").where("doc_id != m").select(F.col("doc_id").alias("a"), F.col("m").alias("b"))
    blocks = cut(components(near, "blocks").select(F.col("v").alias("doc_id"), F.col("comp").alias("block")), "blocks")
    counts = cut(blocks.groupBy("block").agg(F.count(F.lit(1)).alias("m")), "blocks")
    dealt = blocks.join(counts, "block").withColumn("subs", F.ceil(F.col("m") / block_size).cast("int"))
    bins = shuffle_partitions(spark) * 4
    placed = cut(dealt.select(
        "doc_id", "block", "subs", "m",
        F.when(F.col("subs") > 1, F.col("block")).otherwise(F.pmod(F.xxhash64("block"), F.lit(bins))).alias("bin"),
        F.when(F.col("subs") > 1, F.pmod(F.xxhash64("doc_id"), F.col("subs"))).otherwise(F.lit(-1)).cast("int").alias("sub"),
        ((F.col("subs") > 1) & (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.ceil(F.col("m") / PIVOTS)) == 0)).alias("pivot")),
        "blocks")
    rows_ = live.join(placed, "doc_id").withColumn("ask", F.lit(True))
    cols = ["bin", "sub", "block", "doc_id", "n", "keys", "ask"]
    shared = rows_.where("pivot").withColumn("s", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))) \
        .where("s != sub").withColumn("sub", F.col("s"))
    first = rows_.select(*cols).unionByName(shared.select(*cols))
    join = _joiner(num, den)
    edges = cut(first.groupBy("bin", "sub").applyInArrow(join, "a long, b long"), "links")
    hot = placed.where("subs > 1")
    if not hot.limit(1).count():
        return edges
    comp = components(edges.join(hot.select(F.col("doc_id").alias("a")), "a", "left_semi"), "hot")
    own = cut(hot.join(comp, hot.doc_id == comp.v, "left")
              .select("doc_id", "block", "subs", "sub", F.coalesce("comp", "doc_id").alias("comp")), "hot")
    largest = cut(own.groupBy("block", "comp").agg(F.count(F.lit(1)).alias("c"))
                  .groupBy("block").agg(F.max(F.struct("c", "comp")).comp.alias("giant")), "hot")
    stray = own.join(largest, "block").where("comp != giant")
    per = cut(stray.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias("asks")), "hot")
    if not per.limit(1).count():
        return edges
    full = own.join(per, "block").join(live, "doc_id")
    cell = F.col("sub") * F.col("asks") + F.col("q")
    trees = full.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
    asked = stray.select("doc_id").join(full, "doc_id") \
        .withColumn("q", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.col("asks")).cast("int")) \
        .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).withColumn("sub", F.col("s"))
    pick = lambda df, ask: df.select(F.col("block").alias("bin"), cell.cast("int").alias("sub"), "block", "doc_id", "n",
                                     "keys", F.lit(ask).alias("ask"))
    more = pick(trees, False).unionByName(pick(asked, True))
    return edges.unionByName(more.groupBy("bin", "sub").applyInArrow(join, "a long, b long"))


def _content(text: str = "text"):
    return F.coalesce(F.md5(F.col(text)), F.lit("null")).alias("hash")


def vertices(docs: DataFrame) -> DataFrame | None:
    """(doc_id, hash, v): a number of its own, ``v``, for each text of the
    doc_ids that stand on several texts; None if no doc_id does. Numbers are
    hashes, drawn anew should two of them or a doc_id be equal."""
    keyed = docs.select("doc_id", _content())
    shared = cut(keyed.groupBy("doc_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
                 .where("low != high").select("doc_id"), "shared")
    if not shared.limit(1).count():
        return None
    texts = cut(keyed.join(shared, "doc_id", "left_semi").distinct(), "shared")
    draw = 0
    while True:
        named = texts.withColumn("v", F.xxhash64(F.lit(draw), "doc_id", "hash"))
        taken = docs.select(F.col("doc_id").alias("v"))
        if not (named.groupBy("v").count().where("count > 1").limit(1).count() or named.join(taken, "v", "left_semi").limit(1).count()):
            return cut(named, "vertices")
        draw += 1


def _numbered(docs: DataFrame, named: DataFrame | None) -> DataFrame:
    """``docs`` with ``_v``: the number of the row's text, its doc_id as a rule."""
    if named is None:
        return docs.withColumn("_v", F.col("doc_id").cast("long"))
    named = named.select(F.col("doc_id").alias("_doc"), F.col("hash").alias("_hash"), F.col("v").alias("_named"))
    same = (F.col("doc_id").cast("long") == F.col("_doc")) & (F.coalesce(F.md5(F.col("text").cast("string")), F.lit("null")) == F.col("_hash"))
    return docs.join(named, same, "left").withColumn("_v", F.coalesce("_named", F.col("doc_id").cast("long"))).drop("_doc", "_hash", "_named")


def _classes(docs: DataFrame, named: DataFrame | None, size: int, num: int, den: int, block_size: int) -> DataFrame:
    """(v, doc_id, n, component_id, first) per row with a doc_id; ``first`` is the
    text that stands for its component."""
    docs = _numbered(docs, named).select(F.col("_v").alias("doc_id"), "text")
    copies = cut(copies_of(docs, "copies"), "copies")
    every = cut(sets(docs, copies, size, num, den), "sets")
    live = every.where("keys is not null")
    edges = _edges(live, num, den, block_size)
    sized = every.select("doc_id", "n")
    twins = copies.join(sized.select(F.col("doc_id").alias("rep"), "n").distinct(), "rep").select("doc_id", "rep", "n")
    linked = components(edges.unionByName(
        twins.where("n > 0").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))), "components")
    out = sized.unionByName(twins.select("doc_id", "n")).join(linked, F.col("doc_id") == linked.v, "left") \
        .select(F.col("doc_id").alias("v"), "n", F.coalesce("comp", "doc_id").alias("comp"))
    if named is None:
        return out.select("v", F.col("v").alias("doc_id"), "n", F.col("comp").alias("component_id"), (F.col("v") == F.col("comp")).alias("first"))
    out = cut(out.join(named.select("v", "doc_id"), "v", "left").withColumn("doc_id", F.coalesce("doc_id", "v")), "classes")
    first = out.groupBy("comp").agg(F.min(F.struct("doc_id", "v")).alias("low"))
    return out.join(first, "comp").select("v", "doc_id", "n", F.col("low.doc_id").alias("component_id"), (F.col("v") == F.col("low.v")).alias("first"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def jaccard_components(docs: DataFrame, size: int = WORDS, num: int = NUM, den: int = DEN,
                       block_size: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document."""
    docs = _plain(docs)
    return _classes(docs, vertices(docs), size, num, den, block_size).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def jaccard_dedup(docs: DataFrame, size: int = WORDS, num: int = NUM, den: int = DEN, block_size: int = BLOCK) -> DataFrame:
    """``docs`` with the first document of every component (the smallest doc_id;
    of texts that share it, one); rows without a ``doc_id`` stay."""
    plain = _plain(docs)
    named = vertices(plain)
    drop = _classes(plain, named, size, num, den, block_size).where("not first").select(F.col("v").alias("_v")).distinct()
    return _numbered(docs, named).join(drop, "_v", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
