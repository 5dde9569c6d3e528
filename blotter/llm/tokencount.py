"""Token counts by a two-tier lookup of pre-token lengths, all on the map side.

A text is cut into pre-tokens that no merge of the vocabulary can join: before
each run of spaces, and around every ASCII character that stands in no longer
piece (line ends and digits, as a rule). A pre-token's number of pieces then
depends on itself alone, and a text's count is a sum.

Tier one is a compact hash table of the frequent pre-tokens with their numbers
of pieces, broadcast to the tasks: ``TABLE`` entries of at most ``WIDTH`` bytes,
compared byte for byte, so it never answers for another pre-token. What it
misses goes to tier two, the worker's cache of at most ``CACHE`` pre-tokens,
filled by encoding the new ones in one library call a slice.

The frequent pre-tokens come from all texts. Every task keeps a summary of
``TABLE`` counters (all counters lose the first count that has no place, so
whatever occurs in more than 1 of ``TABLE`` pre-tokens stays), and summaries of
fixed size are merged ``FAN`` at a time; no pre-token is shuffled. The table
only saves time: results are the same with any table.

Null text is empty, with no tokens. Rows are kept one for one, also those with
a null or repeated doc_id; other columns are ignored. A text of any length is
handled in slices of ``SLICE`` bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, cut, ship
from .text import flat, mix

TABLE = 16_384
WIDTH = 24  # bytes; three machine words
FAN = 32
CACHE, CACHED = 300_000, 96  # pre-tokens in a worker's cache; bytes of the longest kept
SLICE = 4 << 20
LIMIT = 4096
SPACE = "▁"
_K = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)  # masks of 0 to 8 bytes
SUMMARY = "part int, words binary, size binary, n binary"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Library:
    """Numbers of pieces from the library, and where its vocabulary lets texts be cut."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        joined: set[str] = set()
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            if self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i):
                continue
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} goes over a word's end")
            if len(piece) > 1:
                joined.update(piece)
        self.alone = np.array([i < 128 and i != 0x20 and chr(i) not in joined for i in range(256)])
        if not self.alone[0x0A]:
            raise ValueError("line ends are part of longer pieces")
        # the library puts a space in front of every text; a line end keeps it apart
        self.front = len(self.sp.encode("\n"))

    def counts(self, pretokens: list[bytes]) -> list[int]:
        got = self.sp.encode(["\n" + p.decode() for p in pretokens], num_threads=1)
        return [len(ids) - self.front for ids in got]


_LIBRARIES: dict[str, Library] = {}


def library(path: str) -> Library:
    if path not in _LIBRARIES:
        _LIBRARIES[path] = Library(path)
    return _LIBRARIES[path]


def marked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts as the library sees them: a space in front
    of each that is not empty, and the library's own mark read as a space."""
    space, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    texts = pc.fill_null(pc.replace_substring(texts.cast(pa.large_string()), SPACE, " "), none)
    return flat(pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(space, texts, none)))


def pretokens(raw: np.ndarray, offsets: np.ndarray, alone: np.ndarray, size: int | None = None):
    """Slices of the buffer: (first byte, pre-tokens' starts in it, their ends,
    the slice). A slice ends with a pre-token."""
    size = size or SLICE
    a, wide = 0, size
    while a < len(raw):
        part = raw[a:a + wide]
        space, single = part == 0x20, alone[part]
        begin = single.copy()
        begin[1:] |= single[:-1] | (space[1:] & ~space[:-1])
        lo, hi = np.searchsorted(offsets, [a, a + len(part)])
        begin[offsets[lo:hi] - a] = True
        begin[0] = True
        start = np.flatnonzero(begin)
        if a + len(part) < len(raw):
            if len(start) == 1:  # one pre-token fills the slice
                wide *= 2
                continue
            start, stop = start[:-1], int(start[-1])
        else:
            stop = len(part)
        yield a, start, np.append(start[1:], stop), part[:stop]
        a, wide = a + stop, size


def packed(part: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of at most WIDTH bytes as rows of machine words, zero-filled, and their sizes."""
    padded = np.concatenate([part, np.zeros(WIDTH + 8, np.uint8)])
    eight = np.ndarray((len(part) + WIDTH + 1,), "<u8", buffer=padded, strides=(1,))
    size = end - start
    words = np.empty((len(start), WIDTH // 8), np.uint64)
    for k in range(WIDTH // 8):
        words[:, k] = eight[start + 8 * k] & _BYTES[np.clip(size - 8 * k, 0, 8)]
    return words, size.astype(np.uint8)


def hashed(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    h = size.astype(np.uint64) * _K
    for k in range(words.shape[1]):
        h = mix((h ^ words[:, k]) * _K)
    return h


def summed(words: np.ndarray, size: np.ndarray, n: np.ndarray, keep: int):
    """A summary of at most ``keep`` counters: equal rows add up, and if more
    are left, all lose the count of the first one without a place."""
    _, first, same = np.unique(hashed(words, size), return_index=True, return_inverse=True)
    words, size, n = words[first], size[first], np.bincount(same, n, len(first)).astype(np.int64)
    if len(n) > keep:
        n = n - np.partition(n, len(n) - keep - 1)[len(n) - keep - 1]
        words, size, n = words[n > 0], size[n > 0], n[n > 0]
    return words, size, n


def _blank():
    return np.zeros((0, WIDTH // 8), np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)


def _summary_row(part: int, found) -> pa.RecordBatch:
    words, size, n = found
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (words.astype("<u8"), size, n.astype("<i8"))]],
        ["part", "words", "size", "n"])


def _read_summary(words: bytes, size: bytes, n: bytes):
    return np.frombuffer(words, "<u8").reshape(-1, WIDTH // 8), np.frombuffer(size, np.uint8), np.frombuffer(n, "<i8")


def _summarise(path: str, keep: int):
    def run(batches):
        from pyspark import TaskContext
        lib, found = library(path), _blank()
        for b in batches:
            raw, offsets = marked(b.column(0))
            for _, start, end, part in pretokens(raw, offsets, lib.alone):
                use = ~lib.alone[part[start]] & (end - start <= WIDTH)
                words, size = packed(part, start[use], end[use])
                new = summed(words, size, np.ones(len(size), np.int64), len(size))
                found = summed(*[np.concatenate(x) for x in zip(found, new)], keep)
        if len(found[2]):
            yield _summary_row(TaskContext.get().partitionId(), found)
    return run


def _merge(keep: int):
    def run(rows: pa.Table) -> pa.Table:
        found = _blank()
        for row in rows.select(["words", "size", "n"]).to_pylist():
            found = summed(*[np.concatenate(x) for x in zip(found, _read_summary(**row))], keep)
        return pa.Table.from_batches([_summary_row(rows.column("part")[0].as_py(), found)])
    return run


class Lengths:
    """Open-addressed table: pre-token to number of pieces, or -1."""

    def __init__(self, words: np.ndarray, size: np.ndarray, pieces: np.ndarray):
        self.words, self.size, self.pieces = words, size, pieces
        slots = 1 << max(4, int(4 * len(size)).bit_length())
        self.slot, self.mask = np.full(slots, -1, np.int32), np.uint64(slots - 1)
        at = (hashed(words, size) & self.mask).astype(np.int64)
        for i, place in enumerate(at.tolist()):
            while self.slot[place] >= 0:
                place = (place + 1) % slots
            self.slot[place] = i

    def get(self, words: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.full(len(size), -1, np.int64)
        at, rest = (hashed(words, size) & self.mask).astype(np.int64), np.arange(len(size))
        while len(rest):
            entry = self.slot[at]
            rest, at, entry = rest[entry >= 0], at[entry >= 0], entry[entry >= 0]
            same = self.size[entry] == size[rest]
            for k in range(words.shape[1]):
                same &= self.words[entry, k] == words[rest, k]
            out[rest[same]] = self.pieces[entry[same]]
            rest, at = rest[~same], (at[~same] + 1) & int(self.mask)
        return out


def frequent(docs: DataFrame, path: str, keep: int = TABLE) -> Lengths:
    """The table of the corpus' frequent pre-tokens; at most ``keep`` entries reach the driver."""
    rows = cut(docs.select("text").mapInArrow(_summarise(path, keep), SUMMARY), "op11-summaries")
    while rows.count() > 1:
        rows = cut(rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part")
                   .applyInArrow(_merge(keep), SUMMARY), "op11-merged")
    last = rows.select("words", "size", "n").collect()
    words, size, _ = _read_summary(*last[0]) if last else _blank()
    texts = [w.tobytes()[:s] for w, s in zip(words.astype("<u8"), size.tolist())]
    return Lengths(words, size, np.array(library(path).counts(texts), np.int64))


_CACHES: dict[str, dict[bytes, int]] = {}


def _misses(lib: Library, cache: dict[bytes, int], part: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    blob = part.tobytes()
    texts = [blob[s:e] for s, e in zip(start.tolist(), end.tolist())]
    new = [t for t in set(texts) if t not in cache]
    found = dict(zip(new, lib.counts(new)))
    out = np.array([found[t] if t in found else cache[t] for t in texts], np.int64)
    if len(cache) + len(new) > CACHE:
        cache.clear()
    for t, n in found.items():
        if len(t) <= CACHED and len(cache) < CACHE:
            cache[t] = n
    return out


def _counter(path: str, table, limit: int):
    def run(batches):
        lib, lengths, cache = library(path), table.value, _CACHES.setdefault(path, {})
        for b in batches:
            texts = column(b, "text")
            raw, offsets = marked(texts)
            tokens = np.zeros(b.num_rows, np.int64)
            for a, start, end, part in pretokens(raw, offsets, lib.alone):
                n = np.ones(len(start), np.int64)
                rest = np.flatnonzero(~lib.alone[part[start]])
                short = rest[end[rest] - start[rest] <= WIDTH]
                n[rest] = -1
                n[short] = lengths.get(*packed(part, start[short], end[short]))
                rest = rest[n[rest] < 0]
                n[rest] = _misses(lib, cache, part, start[rest], end[rest])
                doc = np.searchsorted(offsets, start + a, side="right") - 1
                tokens += np.bincount(doc, n, b.num_rows).astype(np.int64)
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(tokens), pa.array(tokens > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, keep: int = TABLE) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``."""
    spark, path = docs.sparkSession, path or default_path()
    ship(spark)
    table = spark.sparkContext.broadcast(frequent(docs, path, keep))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_counter(path, table, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
