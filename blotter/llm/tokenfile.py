"""Token-ID output: a binary format with static range asymmetric numeral coding.

Documents are put in ascending doc_id order by a range shuffle; each task
writes one shard. A shard is cut into cells of about ``CELL`` blocks at document
ends, and a cell row is all that decoding needs: the shard's shared frequency
table, the blocks of ``BLOCK`` ids, which are coded independently, per block a
checkpoint (the coders' states and word counts) and a CRC-32 of its ids, and the
documents with their lengths. Within a block ``LANES`` interleaved coders take
every LANES-th id; all lanes of a cell advance together in numpy. Cells are read
in parallel, without a shuffle, and a damaged block is found.

Coding: 63-bit states, 32-bit renormalisation, frequencies scaled to
2**``SCALE`` with at least 1 for every id of the shard.

Cells are rows of Parquet files, which Spark reads from any store: ``shard,
cell, table, lens, payloads, states, crcs, docs, counts``.

Null text is empty: a document of the end id alone. Rows with a null doc_id are
left out. Rows that share a doc_id are written one after another, ordered by
their text, and read back as one row each. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import shuffle_partitions, ship
from .text import flat, hash_spans, ranges, slices, words

END = 2
SCALE = 18
LANES = 32
BLOCK = 16384
CELL = 64
CACHE_WORDS = 1_500_000
CACHE_IDS = 16_000_000
SLICE = 1 << 21  # bytes of text encoded at once
LEARN = 10000  # words given to the tokenizer at once
MARK, RUN = "<|startoftext|>", 200  # a special token of the file; words of a run that it ends
WORD_END = "</w>"  # ends the last piece of a run of letters
LOW = 1 << 31  # a state stays within [LOW, LOW << 32)
_ALNUM = np.zeros(256, bool)
_MARK = np.zeros(256, bool)  # ASCII punctuation but for the apostrophe
_MARK[33:127] = True
for _a, _z in (("0", "9"), ("A", "Z"), ("a", "z")):
    _ALNUM[ord(_a):ord(_z) + 1] = True
_MARK &= ~_ALNUM
_MARK[ord("'")] = False


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def parts(raw: np.ndarray, w):
    """(start, end, first) of the words with marks at their end taken apart
    after an ASCII letter or digit or a letter of Latin-1;
    ``first`` is each document's first part."""
    if not len(w.start):
        return w.start, w.end, w.first
    # a stem ends after the last byte that is no mark
    solid = np.flatnonzero(~_MARK[raw])
    marked = np.flatnonzero(_MARK[raw[w.end - 1]])
    stem = w.end.copy()
    stem[marked] = np.append(-1, solid)[np.searchsorted(solid, w.end[marked])] + 1
    last = raw[np.maximum(stem - 1, 0)]
    # U+00C0 to U+00FF are letters but for the signs of multiplication and division
    latin = (last >= 0x80) & (last < 0xC0) & (last != 0x97) & (last != 0xB7) & (raw[np.maximum(stem - 2, 0)] == 0xC3)
    cut = (stem > w.start) & (stem < w.end) & (_ALNUM[last] | latin)
    tail = raw[np.minimum(stem, len(raw) - 1)], raw[np.minimum(stem + 1, len(raw) - 1)]
    cut &= (tail[0] != ord("|")) | (tail[1] != ord(">"))  # special tokens stay whole
    at = np.concatenate([[0], np.cumsum(1 + cut)])
    start, end = np.repeat(w.start, 1 + cut), np.repeat(w.end, 1 + cut)
    end[at[:-1][cut]] = stem[cut]
    start[at[1:][cut] - 1] = stem[cut]
    return start, end, at[w.first]


def distinct(h: np.ndarray):
    """(sorted values, a place of each, each element's value); any place will do,
    so the sort need not be stable."""
    order = np.argsort(h)
    ranked = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], order[new], which


class Encoder:
    """Ids of texts. The tokenizer splits at white space, and between letters
    or digits and punctuation, before it merges. So the ids of a text are those
    of its words (``[^\\x20\\x09-\\x0D]+``), with marks at a word's end taken
    apart; each worker remembers up to ``CACHE_WORDS`` words that it has met,
    of about ``CACHE_IDS`` ids together."""

    def __init__(self, path: str):
        # Spark gives a task one core: the library's threads would only add their
        # own memory and hand-over time.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the file's normalizer and split leave words of a to z as they are: the same model without them
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.mark = self.tokenizer.token_to_id(MARK)
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for piece, i in vocab.items() if piece.endswith(WORD_END)]] = True
        self.forget()

    def forget(self):
        self.word, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _ids(self, texts, joined):
        """(ids of all ``texts``, number of ids of each). Where no text holds a
        special token, runs of texts go to the library as one, each ended by
        ``MARK``, which splits a text as its end does; that saves its cost a call."""
        if joined and self.mark is not None:
            runs = ["".join(t + MARK for t in texts[i:i + RUN]) for i in range(0, len(texts), RUN)]
        else:
            runs = texts
        got = [e.ids for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(got), np.int32)
        if runs is texts:
            return ids, np.array([len(g) for g in got], np.int64)
        ends = np.flatnonzero(ids == self.mark)
        return ids[ids != self.mark], np.diff(ends, prepend=-1) - 1

    def _letters(self, texts, joined, tokenizer=None):
        """``_ids`` of texts of letters alone. Each is one run to the tokenizer, so
        the library gets many with a space between, which costs it less than
        ``MARK``; a piece that ends a run ends the text. Where the ends do not
        agree with the texts (a letter that the tokenizer takes apart), ``_ids``."""
        runs = [" ".join(texts[i:i + RUN]) for i in range(0, len(texts), RUN)]
        got = [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(runs, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(got), np.int32)
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(texts) or (len(ends) and ends[-1] != len(ids) - 1):
            return self._ids(texts, joined)
        return ids, np.diff(ends, prepend=-1)

    def _ascii(self, texts, joined):
        return self._letters(texts, joined, self.bare)

    def _learn(self, keys, check, texts, joined):
        letters = np.array([t.lower().isalpha() for t in texts], bool)
        ascii_ = letters & np.array([t.isascii() and t.islower() for t in texts], bool)
        order, got = [], []
        for of, encode in ((ascii_, self._ascii), (letters & ~ascii_, self._letters), (~letters, self._ids)):
            order.append(np.flatnonzero(of))
            some = [texts[i] for i in order[-1].tolist()]
            got += [encode(some[i:i + LEARN], joined) for i in range(0, len(some), LEARN)]
        order, each = np.concatenate(order), np.concatenate([n for _, n in got])
        size, at = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        size[order], at[order] = each, len(self.pool) + np.cumsum(each) - each
        self.pool = np.concatenate([self.pool, *[ids for ids, _ in got]])
        place = np.searchsorted(self.word, keys)
        self.word, self.check = np.insert(self.word, place, keys), np.insert(self.check, place, check)
        self.at, self.size = np.insert(self.at, place, at), np.insert(self.size, place, size)

    def encode(self, texts: pa.Array):
        """Slices of (ids with the end id, number of ids of each document)."""
        raw, offsets = flat(texts)
        for i, j in slices(offsets, SLICE):
            part = raw[offsets[i]:offsets[j]]
            # the tokenizer lower-cases, but finds special tokens before it does
            plain = b"<|" not in part.tobytes()
            w = words(part, offsets[i:j + 1] - offsets[i], lower=plain)
            part = w.raw
            start, end, first_of = parts(part, w)
            h = hash_spans(part, start, end, seed=21)
            keys, first, which = distinct(h)
            check = hash_spans(part, start[first], end[first], seed=22)
            place = np.searchsorted(self.word, keys)
            at = np.minimum(place, max(0, len(self.word) - 1))
            known = (self.word[at] == keys) if len(self.word) else np.zeros(len(keys), bool)
            if known.any() and not np.array_equal(self.check[at][known], check[known]):
                self.forget()  # two words of one hash: start anew
                known[:] = False
            if not known.all():
                if len(self.word) + int((~known).sum()) > CACHE_WORDS or len(self.pool) > CACHE_IDS:
                    self.forget()
                    known[:] = False
                new = np.flatnonzero(~known)
                blob = part.tobytes()
                self._learn(keys[new], check[new], [blob[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())], plain)
                at = np.searchsorted(self.word, keys)
            size, from_ = self.size[at][which], self.at[at][which]
            total = np.concatenate([[0], np.cumsum(size)])
            count = np.diff(total[first_of])
            body = self.pool[ranges(from_, size)]
            out = np.full(len(body) + len(count), END, np.int32)
            mask = np.ones(len(out), bool)
            mask[np.cumsum(count + 1) - 1] = False
            out[mask] = body
            yield out, count + 1


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least 1 where ``counts`` is not 0."""
    total, room = int(counts.sum()), 1 << SCALE
    if total == 0:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * room // total), 0)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    gap = room - int(freq.sum())
    if gap > 0:
        freq[order[0]] += gap
    while gap < 0:  # take from the most frequent
        take = np.minimum(freq[order] // 2, -gap)
        before = np.cumsum(take) - take
        take = np.clip(np.minimum(take, -gap - before), 0, None)
        freq[order] -= take
        gap += int(take.sum())
    return freq


def lane_order(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lanes from the longest to the shortest, lanes with an id at each step,
    that id's place): the lanes that still run are then the first ones."""
    block, number = np.divmod(np.arange(len(lens) * LANES), LANES)
    size = np.maximum(0, (lens[block] - number + LANES - 1) // LANES)
    by_length = np.argsort(-size, kind="stable")
    steps = np.arange(int(size.max(initial=0)))
    live = np.searchsorted(-size[by_length], -steps, side="left")
    first = ((np.cumsum(lens) - lens)[block] + number)[by_length]
    places = np.minimum(first + steps[:, None] * LANES, max(0, int(lens.sum()) - 1))
    return by_length, live, places


def rans_encode(ids: np.ndarray, freq: np.ndarray, lens: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """(payload, states) of every block; ``lens`` are the blocks' ids. Lanes of
    all blocks run together, from the last id to the first."""
    start = np.concatenate([[0], np.cumsum(freq)])
    blocks = len(lens)
    lanes = blocks * LANES
    by_length, live, places = lane_order(lens)
    state = np.full(lanes, LOW, np.uint64)
    out_lane, out_word = [], []
    symbols = ids[places]
    shift, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    for t in range(len(live) - 1, -1, -1):
        s = symbols[t, :live[t]]
        f, c = freq[s].astype(np.uint64), start[s].astype(np.uint64)
        x = state[:live[t]]
        full = np.flatnonzero(x >= (f << np.uint64(63 - SCALE)))
        if len(full):
            y = x[full]
            out_lane.append(by_length[full])
            out_word.append((y & low).astype("<u4"))
            x[full] = y >> shift
        q = x // f
        state[:live[t]] = (q << np.uint64(SCALE)) + (x - q * f) + c
    ranked, state = state, np.empty(lanes, np.uint64)
    state[by_length] = ranked
    lane = np.concatenate(out_lane) if out_lane else np.zeros(0, np.int64)
    word = np.concatenate(out_word) if out_word else np.zeros(0, "<u4")
    order = np.argsort(lane, kind="stable")
    lane, word = lane[order], word[order]
    at = np.searchsorted(lane, np.arange(lanes + 1))
    out = []
    for b in range(blocks):
        lo = b * LANES
        size = np.diff(at[lo:lo + LANES + 1])
        states = np.concatenate([state[lo:lo + LANES].astype("<u8"), size.astype("<u8")])
        out.append((word[at[lo]:at[lo + LANES]].tobytes(), states))
    return out


def rans_decode(payloads: list[bytes], states: list[np.ndarray], lens: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """The ids of blocks that share a frequency table, one after another."""
    start = np.concatenate([[0], np.cumsum(freq)])
    of = np.repeat(np.arange(len(freq)), freq)
    by_length, live, places = lane_order(lens)
    both = np.stack(states).astype(np.int64)
    x = both[:, :LANES].reshape(-1).astype(np.uint64)
    size = both[:, LANES:].reshape(-1)
    word = np.frombuffer(b"".join(payloads), "<u4").astype(np.uint64)
    base = np.cumsum(size) - size
    x, base, at = x[by_length], base[by_length], (base + size)[by_length]  # words come back last first
    out = np.zeros(int(lens.sum()), np.int32)
    mask = np.uint64((1 << SCALE) - 1)
    scale, wide, least = np.uint64(SCALE), np.uint64(32), np.uint64(LOW)
    weight, offset = freq.astype(np.uint64), start.astype(np.uint64)
    for t in range(len(live)):
        y = x[:live[t]]
        slot = y & mask
        s = of[slot]
        out[places[t, :live[t]]] = s
        y = weight[s] * (y >> scale) + slot - offset[s]
        low = np.flatnonzero(y < least)
        if len(low):
            at[low] -= 1
            y[low] = (y[low] << wide) | word[at[low]]
        x[:live[t]] = y
    if not (np.array_equal(at, base) and (x == np.uint64(LOW)).all()):
        raise ValueError("a block does not end in its first state")
    return out


ROW = ("shard int, cell int, table binary, lens array<int>, payloads array<binary>, states array<binary>, crcs array<long>, "
       "docs binary, counts binary")
_ROW = pa.schema([("shard", pa.int32()), ("cell", pa.int32()), ("table", pa.binary()), ("lens", pa.list_(pa.int32())),
                  ("payloads", pa.list_(pa.binary())), ("states", pa.list_(pa.binary())), ("crcs", pa.list_(pa.int64())),
                  ("docs", pa.binary()), ("counts", pa.binary())])
_LOADED: dict[str, Encoder] = {}


def _writer(path: str):
    def run(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        if path not in _LOADED:
            _LOADED[path] = Encoder(path)
        ids, docs, counts, seen = [], [], [], np.zeros(0, np.int64)
        for b in batches:
            docs.append(b.column(0).to_numpy(zero_copy_only=False))
            for body, count in _LOADED[path].encode(b.column(1)):
                ids.append(body.astype("<u4" if len(body) and body.max() > 0xFFFF else "<u2"))
                counts.append(count)
                more = np.bincount(body, minlength=len(seen))
                more[:len(seen)] += seen
                seen = more
        docs = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        if not len(docs):
            return
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        freq = scaled(seen)
        used = np.flatnonzero(freq)
        table = np.array([len(freq), *used, *freq[used]], "<u4").tobytes()
        ends = np.cumsum(counts)
        # cells end with the document that fills them
        cell = (ends - counts) // (CELL * BLOCK)
        cut = np.append(np.flatnonzero(np.diff(cell)) + 1, len(docs))
        a = at = 0
        for number, z in enumerate(cut.tolist()):
            part = ids[at:int(ends[z - 1])]
            lens = np.full(-(-len(part) // BLOCK), BLOCK)
            lens[-1] = len(part) - BLOCK * (len(lens) - 1)
            payloads, states, crcs = [], [], []
            for g in range(0, len(lens), CELL):  # a very long document makes a longer cell
                some, base = lens[g:g + CELL], g * BLOCK
                for payload, state in rans_encode(part[base:base + int(some.sum())], freq, some):
                    payloads.append(payload)
                    states.append(state.tobytes())
            for i in range(0, len(part), BLOCK):
                crcs.append(zlib.crc32(part[i:i + BLOCK].astype("<u4").tobytes()))
            row = (shard, number, table, lens.tolist(), payloads, states, crcs, docs[a:z].astype("<i8").tobytes(),
                   counts[a:z].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _ROW)], schema=_ROW)
            a, at = z, int(ends[z - 1])
    return run


def write(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Write the ids of ``docs`` (doc_id, text) below ``folder``. The number of
    shards follows the session's shuffle partitions."""
    spark = docs.sparkSession
    ship(spark)
    base = docs.where(F.col("doc_id").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text") \
        .mapInArrow(_writer(path or default_path()), ROW).write.parquet(folder)


def _table(data: bytes) -> np.ndarray:
    t = np.frombuffer(data, "<u4").astype(np.int64)
    n = (len(t) - 1) // 2
    freq = np.zeros(int(t[0]), np.int64)
    freq[t[1:1 + n]] = t[1 + n:]
    return freq


_DOC = pa.schema([("shard", pa.int32()), ("cell", pa.int32()), ("inside", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids", pa.binary())])


def _reader(batches):
    for b in batches:
        for row in range(b.num_rows):  # one cell at a time
            r = b.slice(row, 1).to_pylist()[0]
            freq, lens, out = _table(r["table"]), np.array(r["lens"]), []
            for g in range(0, len(lens), CELL):
                ids = rans_decode(r["payloads"][g:g + CELL], [np.frombuffer(x, "<u8") for x in r["states"][g:g + CELL]],
                                  lens[g:g + CELL], freq).astype("<u4")
                for k in range(0, len(ids), BLOCK):
                    if zlib.crc32(ids[k:k + BLOCK].tobytes()) != r["crcs"][g + k // BLOCK]:
                        raise ValueError(f"checksum of shard {r['shard']}, cell {r['cell']}, block {g + k // BLOCK}")
                out.append(ids)
            ids = np.concatenate(out)
            docs, counts = np.frombuffer(r["docs"], "<i8"), np.frombuffer(r["counts"], "<i8")
            at = np.concatenate([[0], np.cumsum(counts)])
            if at[-1] != len(ids):
                raise ValueError(f"documents of shard {r['shard']}, cell {r['cell']} do not fill its blocks")
            for i in range(0, len(docs), 2000):
                j = min(len(docs), i + 2000)
                n = j - i
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, r["shard"]), pa.int32()), pa.array(np.full(n, r["cell"]), pa.int32()), pa.array(at[i:j], pa.int64()),
                    pa.array(docs[i:j], pa.int64()), pa.array(counts[i:j], pa.int64()),
                    pa.array([ids[at[k]:at[k + 1]].tobytes() for k in range(i, j)], pa.binary())], schema=_DOC)


def read(spark, folder: str) -> DataFrame:
    """(shard, cell, inside, doc_id, n_tokens, ids) per document, cell by cell in
    parallel; ``inside`` counts the ids of its cell before it, ``ids`` are
    little-endian unsigned 32-bit integers."""
    ship(spark)
    return spark.read.schema(ROW).parquet(folder) \
        .mapInArrow(_reader, "shard int, cell int, inside long, doc_id long, n_tokens long, ids binary")


def positions(documents: DataFrame, folder: str) -> DataFrame:
    """``read``'s rows of ``folder`` with ``start``, the ids of all documents
    before. The cells' block lengths are summed by shard, then in order, so
    nothing is decoded for it; decoding checks them."""
    cells = documents.sparkSession.read.schema(ROW).parquet(folder) \
        .select("shard", "cell", F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    per = cells.groupBy("shard").agg(F.sum("n").alias("n"))
    shards = per.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    earlier = F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")
    begin = cells.select("shard", "cell", earlier.alias("earlier")).join(shards, "shard") \
        .select("shard", "cell", (F.col("base") + F.col("earlier")).alias("base"))
    return documents.join(begin, ["shard", "cell"]).withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside")


def output_folder(spark) -> str:
    return scratch_path(spark, "llm-tokens")
