"""SentencePiece encoding and decoding with a batched Viterbi walk.

The vocabulary file holds merge ranks, so the segmentation wanted is the one
its merges give. A sequence of pieces is that segmentation exactly when every
two neighbours are (merging their joint text gives the two back). The walk
keeps, for every prefix of a word, its last piece: at a position all pieces
that end there compete, one scores (its neighbour to the left allows it), and
the maximum's length is the backpointer. Words of one length advance together;
substring hashes of all of them probe the sorted piece keys at once.

Text is escaped as the file's library does: a space is put before it and
spaces become U+2581, which therefore reads back as a space. Everything else
round-trips exactly. Characters without a piece become byte pieces.

Null text gives null ids and null ids give null text; empty text gives no ids.
Other columns pass through (names that begin with ``_sp_`` are reserved).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship
from .text import flat, hash_spans, mix, ranges, slices

SPACE = "▁"
CACHE_WORDS = 1_000_000  # words remembered by a worker; it starts anew beyond
SLICE_TEXT = 1 << 20  # bytes encoded at once
SLICE_IDS = 1 << 19  # ids decoded at once
_P = np.uint64(0x9E3779B97F4A7C15)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Piece tables of one vocabulary file, and the words seen so far."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes_: list[bytes] = [b""] * self.size
        self.byte_id = np.zeros(256, np.int64)
        for i in range(self.size):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.rank[p], self.id[p] = sp.get_score(i), i
                self.bytes_[i] = p.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.id))
        self.spaced = np.zeros(self.size, np.int64)
        self.spaced[[i for p, i in self.id.items() if p.startswith(SPACE)]] = 1
        self.text_of = {i: p for p, i in self.id.items()}
        self.power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(self.longest, _P))])
        keys = np.array([self._key(p) for p in self.id], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(self.id.values()), np.int64)[order]
        self.unknown, self.none = self.size, self.size + 1
        self.pairs = np.zeros(0, np.int64)  # sorted neighbours judged so far
        self.allowed = np.zeros(0, bool)
        self.byte_at = np.concatenate([[0], np.cumsum([len(b) for b in self.bytes_])])
        self.byte_pool = np.frombuffer(b"".join(self.bytes_), np.uint8)
        self.forget()

    def forget(self):
        self.word = np.zeros(0, np.uint64)
        self.word_at = np.zeros(0, np.int64)
        self.word_len = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _key(self, piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * _P + np.uint64(ord(c) + 1)
        return mix(h ^ np.uint64(len(piece)))[0]

    def merged(self, text: str) -> list[str]:
        """The merges themselves: best rank first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """May piece ``right`` follow ``left`` (or begin a word, if none)?"""
        out = (left == self.unknown) | (right == self.unknown)
        ask = np.flatnonzero(~out)
        code = left[ask] * np.int64(self.size + 2) + right[ask]
        new = code
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            new = code[self.pairs[at] != code]
        if len(new):
            new = np.unique(new)
            text, none = self.text_of, self.none
            good = []
            for c in new.tolist():
                a, b = divmod(c, self.size + 2)
                good.append(self.merged(text[b]) == [text[b]] if a == none
                            else self.merged(text[a] + text[b]) == [text[a], text[b]])
            at = np.searchsorted(self.pairs, new)
            self.pairs = np.insert(self.pairs, at, new)
            self.allowed = np.insert(self.allowed, at, good)
        out[ask] = self.allowed[np.searchsorted(self.pairs, code)]
        return out

    def walk(self, codes: np.ndarray) -> list[np.ndarray]:
        """Ids of words of one length; ``codes`` is words x characters."""
        n, size = codes.shape
        h = np.zeros((n, size + 1), np.uint64)
        for j in range(size):
            h[:, j + 1] = h[:, j] * _P + (codes[:, j].astype(np.uint64) + np.uint64(1))
        last = np.full((n, size + 1), self.none, np.int64)
        back = np.zeros((n, size + 1), np.int64)
        for j in range(1, size + 1):
            lens = np.arange(1, min(self.longest, j) + 1)
            sub = h[:, j, None] - h[:, j - lens] * self.power[lens]
            key = mix(sub ^ lens.astype(np.uint64))
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            piece = np.where(self.keys[at] == key, self.ids[at], -1)
            piece[:, 0] = np.where(piece[:, 0] < 0, self.unknown, piece[:, 0])
            w, c = np.nonzero(piece >= 0)
            fit = self.neighbours(last[w, j - lens[c]], piece[w, c])
            # a prefix that ends inside no valid sequence has back 0 and last -1
            fit &= last[w, j - lens[c]] >= 0
            score = np.zeros(piece.shape, np.int64)
            score[w, c] = fit * lens[c]
            top = score.argmax(axis=1)
            best = score[np.arange(n), top]
            back[:, j] = best
            last[:, j] = np.where(best > 0, piece[np.arange(n), top], -1)
        back_to, at, rows = np.full(n, size), [], np.arange(n)
        while back_to.any():  # all words step back together
            at.append(np.where(back_to > 0, last[rows, back_to], -1))
            back_to = back_to - back[rows, back_to]
        steps = np.stack(at[::-1], axis=1)
        ids = [r[r >= 0] for r in steps.astype(np.int32)]
        for i in np.flatnonzero((steps == self.unknown).any(axis=1)).tolist():
            whole, j = [], 0
            for p in ids[i].tolist():
                if p == self.unknown:
                    whole.extend(self.byte_id[list(chr(int(codes[i, j])).encode())].tolist())
                    j += 1
                else:
                    whole.append(p)
                    j += len(self.text_of[p])
            ids[i] = np.array(whole, np.int32)
        return ids

    def learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """Add words to the ones remembered."""
        if len(self.word) + len(keys) > CACHE_WORDS and len(self.word):
            self.forget()
        by_size: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            by_size.setdefault(len(t), []).append(i)
        got: list = [None] * len(texts)
        for size, members in by_size.items():
            step = max(1, 400_000 // size)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                codes = np.frombuffer("".join(texts[i] for i in part).encode("utf-32-le"), "<u4").reshape(len(part), size)
                for i, ids in zip(part, self.walk(codes)):
                    got[i] = ids
        lens = np.array([len(g) for g in got], np.int64)
        at = len(self.pool) + np.cumsum(lens) - lens
        self.pool = np.concatenate([self.pool, *got])
        place = np.searchsorted(self.word, keys)
        self.word = np.insert(self.word, place, keys)
        self.word_at = np.insert(self.word_at, place, at)
        self.word_len = np.insert(self.word_len, place, lens)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of every text."""
        texts = pc.replace_substring(texts.cast(pa.large_string()), SPACE, " ")
        space, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        texts = pc.fill_null(texts, none)
        marked = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(space, texts, none))
        raw, offsets = flat(marked)
        out, count = [], [np.zeros(1, np.int64)]
        for i, j in slices(offsets, SLICE_TEXT):
            part, at = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            space = part == 0x20
            begin = space.copy()
            begin[1:] &= ~space[:-1]
            begin[at[:-1][np.diff(at) > 0]] = True
            start = np.flatnonzero(begin)
            end = np.append(start[1:], len(part))
            h = hash_spans(part, start, end, seed=5)
            keys, first, which = np.unique(h, return_index=True, return_inverse=True)
            here = np.searchsorted(self.word, keys)
            known = np.zeros(len(keys), bool)
            inside = here < len(self.word)
            known[inside] = self.word[here[inside]] == keys[inside]
            if not known.all():
                new = np.flatnonzero(~known)
                if len(self.word) + len(new) > CACHE_WORDS:
                    self.forget()
                    new = np.arange(len(keys))
                blob = part.tobytes()
                self.learn(keys[new], [blob[a:b].decode().replace(" ", SPACE) for a, b in
                                       zip(start[first[new]].tolist(), end[first[new]].tolist())])
                here = np.searchsorted(self.word, keys)
            lens = self.word_len[here][which]
            out.append(self.pool[ranges(self.word_at[here][which], lens)])
            total = np.concatenate([[0], np.cumsum(lens)])
            count.append(np.diff(total[np.searchsorted(start, at)]))
        ids = np.concatenate(out) if out else np.zeros(0, np.int32)
        return ids, np.cumsum(np.concatenate(count))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of id sequences. A space that begins the first piece with
        text is the library's own and goes; a space byte there stays. Ids that
        the vocabulary does not have are an error."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < self.size:
            raise ValueError(f"ids run from {ids.min()} to {ids.max()}, the vocabulary from 0 to {self.size - 1}")
        start, size = self.byte_at[ids], self.byte_at[ids + 1] - self.byte_at[ids]
        data = self.byte_pool[ranges(start, size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])
        at = ends[offsets]
        first = np.searchsorted(ends, at[:-1], side="right") - 1  # the piece that the text's first byte is of
        cut = np.zeros(len(first), np.int64)
        some = at[1:] > at[:-1]
        cut[some] = self.spaced[ids[first[some]]]
        return [data[a + c:b].decode("utf-8", "replace") for a, b, c in zip(at.tolist(), at[1:].tolist(), cut.tolist())]


_LOADED: dict[str, Pieces] = {}


def _load(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _encoded(model: Pieces, rows: pa.StructArray, column: str):
    """(rows, ids) of slices of a batch."""
    texts = pc.struct_field(rows, column).cast(pa.string())
    for i, j in slices(flat(texts)[1], SLICE_TEXT):
        part = texts.slice(i, j - i)
        ids, offsets = model.encode(part)
        yield rows.slice(i, j - i), pa.ListArray.from_arrays(
            pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()), mask=part.is_null() if part.null_count else None)


def _texts(model: Pieces, column: pa.Array) -> pa.Array:
    filled = column.fill_null(pa.scalar([], column.type)) if column.null_count else column
    offsets = np.asarray(filled.offsets, np.int64)
    inner = filled.values.slice(offsets[0], offsets[-1] - offsets[0])
    if inner.null_count:
        raise ValueError("a list of ids holds a null")
    ids = inner.to_numpy(zero_copy_only=False).astype(np.int64)
    texts = model.decode(ids, offsets - offsets[0])
    return pa.array([None if e else t for e, t in zip(column.is_null().to_pylist(), texts)], pa.string())


def _encoder(path: str, column: str, back: bool):
    def run(batches):
        model = _load(path)
        for b in batches:
            for rows, ids in _encoded(model, b.column(0), column):
                more = [_texts(model, ids)] if back else []
                yield pa.RecordBatch.from_arrays([rows, ids, *more], ["_sp_row", "_sp_ids", "_sp_text"][:2 + back])
    return run


def _decoder(path: str, column: str):
    def run(batches):
        model = _load(path)
        for b in batches:
            lists = pc.struct_field(b.column(0), column).cast(pa.list_(pa.int32()))
            lens = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            for i, j in slices(np.concatenate([[0], lens]), SLICE_IDS):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), _texts(model, lists.slice(i, j - i))],
                                                 ["_sp_row", "_sp_text"])
    return run


def _through(df: DataFrame, mapper, made: dict[str, tuple[str, T.DataType]]) -> DataFrame:
    """All columns travel once, as one struct; ``made`` names what the mapper adds."""
    ship(df.sparkSession)
    sent = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_sp_row"))
    schema = T.StructType([sent.schema["_sp_row"], *[T.StructField(c, kind) for c, (_, kind) in made.items()]])
    names = {out for out, _ in made.values()}
    keep = [F.col(f"_sp_row.`{c}`") for c in df.columns if c not in names]
    return sent.mapInArrow(mapper, schema).select(*keep, *[F.col(c).alias(out) for c, (out, _) in made.items()])


_IDS, _TEXT = T.ArrayType(T.IntegerType()), T.StringType()


def encode(df: DataFrame, column: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the piece ids of ``column`` as ``out``."""
    return _through(df, _encoder(path or default_path(), column, False), {"_sp_ids": (out, _IDS)})


def decode(df: DataFrame, column: str = "ids", out: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with the text of the ids in ``column`` as ``out``."""
    return _through(df, _decoder(path or default_path(), column), {"_sp_text": (out, _TEXT)})


def encode_decode(df: DataFrame, column: str = "text", out: str = "ids", back: str = "decoded", path: str | None = None) -> DataFrame:
    """Both in one pass: the ids of ``column``, and the text of those ids."""
    return _through(df, _encoder(path or default_path(), column, True), {"_sp_ids": (out, _IDS), "_sp_text": (back, _TEXT)})
