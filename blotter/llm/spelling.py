"""Spelling variants: words at one edit, through a trie of letter-group counts.

Words that are one letter apart have nearly the same counts of letters: an
insertion adds one to one group of letters, a replacement adds one to a group
and takes one from another (or stays within a group). A trie arranges words by
successive counts; a search follows its own counts and may spend one surplus and
one deficit on the way; the words at the leaves it reaches are verified letter
by letter.

The trie is dealt over tasks by its top, the counts of ``GROUPS`` coarse groups.
A word goes to the subtree of its own counts as a member and, as a query, to each
subtree that its budget allows, shorter words looking for longer ones and one of
two equal tops for the other, so each pair is met once. Where more than ``LOAD``
rows would meet in a subtree, the rows go on to the subtrees below it, one for
each vector of all ``CLASSES`` fine counts; there are at most (1 + GROUPS +
GROUPS**2 / 2) * words / LOAD such tops, and they are broadcast. Within a task
the search is one numpy walk: all queries go down together, level by level.

Links are added up per word before they are shuffled: number of near words and
the best one, not the pairs.

Fixed rule of the counted words: see ``word_counts``. Null text has no words, a
null doc_id is written as empty; other columns are ignored; empty tables have no
words. Words may be of any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, cut, ship, shuffle_partitions

LETTERS, TIMES, PART, RATIO = 6, 5, 199, 5
GROUPS, CLASSES = 5, 32
LOAD = 1_000_000  # rows that may meet in one subtree of the top
BIN = 300_000  # rows of one task call on average
COUNTED = 200_000  # distinct words in a task's counter
CELLS = 4_000_000  # letters of queries searched at once
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LETTERS},}}")
# The 26 plain letters have a class each, the others share six. Classes stand in
# an order in which each coarse group is a range of them.
_ORDER = np.array([(i * 7) % CLASSES for i in range(CLASSES)])
_CLASS = np.zeros(256, np.uint8)
for _c in range(256):
    _CLASS[_c] = _ORDER[_c - 97 if 97 <= _c <= 122 else 26 + _c % 6]
_GROUP = np.arange(CLASSES) * GROUPS // CLASSES
_KEY = np.random.default_rng(13).integers(1, 1 << 63, CLASSES + GROUPS, dtype=np.uint64) | np.uint64(1)


# --- the counted words -------------------------------------------------------

def _words_of(doc_id, text: str) -> list[str]:
    """Runs of six letters or more, A-Z lowered; where 199 divides the CRC-32 of
    ``<doc_id>:<run>``, the run loses its letter number (CRC-32 modulo its length)."""
    runs = _RUN.findall(text.encode().lower().decode())
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for i, run in enumerate(runs):
        h = zlib.crc32(run.encode(), seed)
        if h % PART == 0:
            at = h % len(run)
            runs[i] = run[:at] + run[at + 1:]
    return runs


def _count(batches):
    def rows(found):
        words = [w for w in found if len(w) >= LETTERS]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([found[w] for w in words], pa.int64())], ["word", "n"])
    found: Counter = Counter()
    for b in batches:
        for doc_id, text in zip(column(b, "doc_id"), column(b, "text")):
            text = text.as_py()
            if text:
                found.update(_words_of(doc_id.as_py(), text))
                if len(found) > COUNTED:
                    yield rows(found)
                    found = Counter()
    yield rows(found)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least six letters that occur at least five times."""
    return docs.select("doc_id", "text").mapInArrow(_count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= TIMES)


# --- the trie ------------------------------------------------------------------

def counts_of(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fine counts of words given as Latin-1 bytes and their offsets (words + 1)."""
    n = len(first) - 1
    word = np.repeat(np.arange(n), np.diff(first))
    return np.bincount(word * CLASSES + _CLASS[raw], minlength=n * CLASSES).reshape(n, CLASSES)


def _tops(fine: np.ndarray) -> np.ndarray:
    return np.add.reduceat(fine, np.searchsorted(_GROUP, np.arange(GROUPS)), axis=1)


def _top_key(top: np.ndarray) -> np.ndarray:
    return (top.astype(np.uint64) * _KEY[CLASSES:]).sum(axis=1, dtype=np.uint64)


def _fine_key(fine: np.ndarray) -> np.ndarray:
    return (fine.astype(np.uint64) * _KEY[:CLASSES]).sum(axis=1, dtype=np.uint64)


_MEMBER, _INSERT, _REPLACE, _SAME = 0, 1, 2, 3  # the last looks within its own subtree


def _messages(fine: np.ndarray):
    """(kind, word rows, keys of tops, surplus group, deficit group) of all
    subtrees that words go to; -1: no such group, or both in the same one."""
    top = _tops(fine)
    own, every = _top_key(top), np.arange(len(fine))
    yield _MEMBER, every, own, -1, -1
    yield _SAME, every, own, -1, -1
    for s in range(GROUPS):
        yield _INSERT, every, own + _KEY[CLASSES + s], s, -1
        for d in range(GROUPS):
            if d != s:  # one of two tops looks for the other
                key = own + _KEY[CLASSES + s] - _KEY[CLASSES + d]
                some = np.flatnonzero((top[:, d] > 0) & (key > own))
                yield _REPLACE, some, key[some], s, d


def _below(fine: np.ndarray, kind: int, s: int, d: int):
    """(kind, rows, keys) of the fine subtrees below a top for the words ``fine``."""
    own, every = _fine_key(fine), np.arange(len(fine))
    inside = [np.flatnonzero(_GROUP == g) for g in range(GROUPS)]
    if kind == _MEMBER:
        yield kind, every, own
    elif kind == _INSERT:
        for x in inside[s]:
            yield kind, every, own + _KEY[x]
    elif kind == _REPLACE:
        for y in inside[d]:
            some = np.flatnonzero(fine[:, y] > 0)
            for x in inside[s]:
                yield kind, some, own[some] + _KEY[x] - _KEY[y]
    else:  # within a group; the smaller of two keys looks for the other
        yield _SAME, every, own
        for group in inside:
            for y in group:
                for x in group[group != y]:
                    key = own + _KEY[x] - _KEY[y]
                    some = np.flatnonzero((fine[:, y] > 0) & (key > own))
                    yield _REPLACE, some, key[some]


def _latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    texts = [w.encode("latin-1") for w in words.to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer(b"".join(texts), np.uint8), first, texts


def _loads(batches):
    for b in batches:
        raw, first, _ = _latin(b.column(0))
        keys = np.concatenate([k for _, _, k, _, _ in _messages(counts_of(raw, first))])
        keys, n = np.unique(keys, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])


def _deal(hot, bins: int):
    """Members and queries with their subtree and its bin."""
    def run(batches):
        tops = hot.value
        for b in batches:
            raw, first, texts = _latin(b.column(0))
            fine, n = counts_of(raw, first), b.column(1).to_numpy()
            words = pa.array(texts, pa.binary())
            for kind, rows, keys, s, d in _messages(fine):
                deep = np.isin(keys, tops)
                parts = [(kind, rows[~deep], keys[~deep])]
                if deep.any():
                    below = rows[deep]
                    parts += [(what, below[r], k) for what, r, k in _below(fine[below], kind, s, d)]
                for what, r, k in parts:
                    if len(r):
                        k = k * np.uint64(0x9E3779B97F4A7C15)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(((k >> np.uint64(33)) % np.uint64(bins)).astype(np.int32)), pa.array(k.view(np.int64)),
                             pa.array(np.full(len(r), what, np.int8)), words.take(pa.array(r)), pa.array(n[r])], ["bin", "key", "kind", "word", "n"])
    return run


class Trie:
    """Members of one length, by subtree and then by successive fine counts."""

    def __init__(self, keys: np.ndarray, fine: np.ndarray):
        self.order = np.lexsort([*fine.T[::-1], keys])
        keys, fine = keys[self.order], fine[self.order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        self.keys = keys[new]
        node = np.cumsum(new) - 1
        self.size = int(fine.max(initial=0)) + 3
        self.levels = []
        for j in range(CLASSES):
            edge = node * self.size + fine[:, j]  # ascending, like the members
            new = np.ones(len(edge), bool)
            new[1:] = edge[1:] != edge[:-1]
            self.levels.append(edge[new])
            node = np.cumsum(new) - 1
        self.first = np.append(np.flatnonzero(new), len(keys))  # members of each leaf

    def search(self, keys: np.ndarray, fine: np.ndarray, deficit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) pairs whose counts agree within the budget."""
        node = np.searchsorted(self.keys, keys)
        query = np.flatnonzero((node < len(self.keys)) & (self.keys[np.minimum(node, len(self.keys) - 1)] == keys))
        node = node[query]
        more, less = np.ones(len(query), np.int8), np.full(len(query), deficit, np.int8)
        for j, edges in enumerate(self.levels):
            step = [(node, fine[query, j], query, more, less)]
            a = np.flatnonzero(more > 0)
            step.append((node[a], fine[query[a], j] + 1, query[a], more[a] - 1, less[a]))
            a = np.flatnonzero((less > 0) & (fine[query, j] > 0))
            step.append((node[a], fine[query[a], j] - 1, query[a], more[a], less[a] - 1))
            node, count, query, more, less = (np.concatenate(x) for x in zip(*step))
            want = np.where(count < self.size, node * self.size + count, -1)
            at = np.minimum(np.searchsorted(edges, want), len(edges) - 1)
            hit = edges[at] == want
            node, query, more, less = at[hit], query[hit], more[hit], less[hit]
        size = self.first[node + 1] - self.first[node]
        at = np.repeat(self.first[node] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.repeat(query, size), self.order[at]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of letters (equal numbers of them, or one more in ``b``) that are exactly one edit apart."""
    size = a.shape[1]
    if a.shape == b.shape:
        return (a != b).sum(axis=1) == 1
    front = np.cumprod(a == b[:, :size], axis=1, dtype=bool).sum(axis=1)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=bool).sum(axis=1)
    return front + back >= size


def _matrix(raw, first, rows, size):
    return raw[first[rows][:, None] + np.arange(size)]


LINKS = "word binary, n_near long, best_n long, best binary"


def _join(rows: pa.Table) -> pa.Table:
    """Links of one bin, added up per word: (number of near words, the best one)."""
    words = column(rows, "word")
    texts = words.to_pylist()
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size, kind = np.diff(first), column(rows, "kind").to_numpy()
    keys, n = column(rows, "key").to_numpy(), column(rows, "n").to_numpy()
    found: dict[bytes, list] = {}

    def link(word, near, near_n):
        best = (-near_n, near)
        got = found.get(word)
        if got is None:
            found[word] = [1, best]
        else:
            got[0] += 1
            got[1] = min(got[1], best)

    def fine_of(some):
        ends = np.concatenate([[0], np.cumsum(size[some])])
        return counts_of(raw[np.repeat(first[some] - ends[:-1], size[some]) + np.arange(ends[-1])], ends)

    for length in np.unique(size[kind == _MEMBER]).tolist():
        members = np.flatnonzero((kind == _MEMBER) & (size == length))
        trie = Trie(keys[members], fine_of(members))
        for what, asks in ((_SAME, length), (_REPLACE, length), (_INSERT, length - 1)):
            queries = np.flatnonzero((kind == what) & (size == asks))
            step = max(1, CELLS // max(asks, CLASSES))
            for at in range(0, len(queries), step):
                some = queries[at:at + step]
                some = some[np.isin(keys[some], trie.keys)]
                if not len(some):
                    continue
                q, m = trie.search(keys[some], fine_of(some), int(what != _INSERT))
                for p in range(0, len(q), step):
                    a, b = some[q[p:p + step]], members[m[p:p + step]]
                    good = one_edit(_matrix(raw, first, a, asks), _matrix(raw, first, b, length))
                    for i, j in zip(a[good].tolist(), b[good].tolist()):
                        if what != _SAME or texts[i] < texts[j]:  # within a subtree both look for each other
                            link(texts[i], texts[j], int(n[j]))
                            link(texts[j], texts[i], int(n[i]))
    return pa.table({"word": pa.array(list(found), pa.binary()), "n_near": pa.array([g[0] for g in found.values()], pa.int64()),
                     "best_n": pa.array([-g[1][0] for g in found.values()], pa.int64()),
                     "best": pa.array([g[1][1] for g in found.values()], pa.binary())})


def near_words(words: DataFrame, load: int = LOAD) -> DataFrame:
    """(word, n_near, best_n, best): of words with near ones, their number and the
    near word with the largest n (the first in code-point order of equals).
    ``words``: distinct Latin-1 words with their n."""
    spark = words.sparkSession
    hot = words.mapInArrow(_loads, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > load).select("key").collect()
    tops = spark.sparkContext.broadcast(np.array([r.key for r in hot], np.int64).view(np.uint64))
    per_word = 2 + GROUPS + GROUPS * (GROUPS - 1) // 2
    bins = max(shuffle_partitions(spark), -(-words.count() * per_word // BIN))
    dealt = words.mapInArrow(_deal(tops, bins), "bin int, key long, kind byte, word binary, n long")
    links = dealt.groupBy("bin").applyInArrow(_join, LINKS)
    text = lambda c: F.decode(c, "ISO-8859-1")
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")) \
        .select(text(F.col("word")).alias("word"), "n_near", (-F.col("b.m")).alias("best_n"), text(F.col("b.best")).alias("best"))


def spelling_groups(docs: DataFrame, load: int = LOAD) -> DataFrame:
    """One row per counted word: word, form, root, n, n_near, form_n. The form is
    the best near word if it occurs five times as often or more; the root is the
    last form on the way."""
    ship(docs.sparkSession)
    words = cut(word_counts(docs), "op13-words")
    form = F.col("best_n") >= RATIO * F.col("n")
    found = cut(words.join(near_words(words, load), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "op13-forms")
    # a form occurs five times as often as its word, so a way has few steps; each round doubles them
    roots = cut(found.where("form is not null").select("word", F.col("form").alias("root")), "op13-roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = cut(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                          F.col("further").isNotNull().alias("moved")), "op13-roots")
        if not roots.where("moved").limit(1).count():
            break
        roots = roots.select("word", "root")
    return found.join(roots.select("word", "root"), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
