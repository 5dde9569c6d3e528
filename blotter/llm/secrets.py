"""Secret scan: fixed patterns, and a character convolutional network.

Base findings are the three patterns below. Further candidates are runs of
``[A-Za-z0-9+/_-]`` of ``LEAST`` characters or more (the least secret of the
base patterns) that touch no base finding; what they are made of is left to the
network. It reads windows of ``WIDTH`` characters: embedded characters, one
convolution, the maximum over positions, one output. Windows slide by ``STEP``
over the whole candidate with ``CONTEXT`` characters on both sides, and the
largest output counts. It starts from ``MADE`` findings and words of each
label written by rule (so a table with few findings has a network and a threshold
too), and is then trained on all labelled findings of the whole table (and on those written by rule beside
them): every base finding, with and without its context, against every further candidate and number,
in its context or, every other one, without. Each task goes over its own documents with
Adam from the same start; the network is the tasks' mean, weighed by findings and
summed by Spark. All windows go through the network; the loss is logistic and ends
at ``MARGIN``, so only windows this side of it move the weights. A window weighs by
its share of its finding, and base findings as if the others were ``PLAIN`` times as many.
A quarter of the findings, dealt by a hash of their characters with all their
windows and copies, is held out. Calibration (Platt) and threshold come from the
largest output of every held-out finding of the table, as in the scan, counted by
label in steps of 1 / ``BINS``: the threshold is the highest that keeps ``RECALL``
of them (with fewer than 50, of them and those written by rule). Candidates at or above it are added as
kind ``cnn``; base findings always stay.

Spans are code points, end exclusive, ordered by start and then kind. Null and
empty texts have none. Rows that share a doc_id each give a row; a null doc_id
passes through; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .text import flat, hash_spans, slices

# The base patterns and their least lengths.
KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs of 32 or more, as [0-9a-f]+ of that length
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
_WORDS = re.compile(rb"password|passwd|secret|token|api_?key|AKIA", re.I)
LEAST = ASSIGN_LEAST
_NUMBER = re.compile(rb"[0-9][0-9().+-]{5,}")
CONTEXT, WIDTH, STEP = 20, 64, 20
SPREAD = 4  # windows of a finding written by rule
SLICE = 1 << 20  # bytes of text padded at once
MADE, EPOCHS, HELD = 600, 30, 4
PLAIN = 6  # weight of all ordinary candidates to that of all base findings
MARGIN = 3.0
BINS, REACH = 64, 64  # steps of an output, and the largest one told apart
BLOCK = 1 << 13  # windows at once
WAIT, TURNS = 4096, 4  # windows this side of the margin that wait for the next steps; steps' turns over them
RECALL = 0.98
EMBED, TAPS, FILTERS = 12, 5, 24

_TOKEN = np.zeros(256, bool)
for _a, _z in (("0", "9"), ("A", "Z"), ("a", "z")):
    _TOKEN[ord(_a):ord(_z) + 1] = True
_TOKEN[[ord(c) for c in "+/_-"]] = True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def patterned(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents that may hold a base finding: a keyword, or 32 token bytes in
    a row. Found on the bytes of all at once."""
    out = np.zeros(len(offsets) - 1, bool)
    if len(raw):
        hits = [m.start() for m in _WORDS.finditer(raw.tobytes())]
        start, end = _runs(_TOKEN[raw], 32)
        hits = np.concatenate([np.array(hits, np.int64), start])
        out[np.searchsorted(offsets, hits, side="right") - 1] = True
        # a run may also begin in the document before
        out[np.searchsorted(offsets, end - 1, side="right") - 1] = True
        inner = np.searchsorted(offsets, start, side="right")
        for i, z in zip(inner.tolist(), (np.searchsorted(offsets, end - 1, side="right") - 1).tolist()):
            out[i:z] = True
    return out


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= least
    return start[long], end[long]


def padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first place) of the documents' characters, WIDTH zeros around each."""
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    lengths = np.diff(chars)
    first = chars[:-1] + WIDTH * np.arange(1, len(lengths) + 1)
    codes = np.zeros(len(points) + WIDTH * (len(lengths) + 1), np.uint8)
    codes[np.arange(len(points)) + np.repeat(first - chars[:-1], lengths)] = np.where((points > 0) & (points < 127), points, 127)
    return codes, first


def extra_spans(codes: np.ndarray, base_start: np.ndarray, base_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Further candidates of ``padded`` codes that touch no base finding (by start)."""
    start, end = _runs(_TOKEN[codes], LEAST)
    if not len(base_start):
        return start, end
    before = np.searchsorted(base_start, end)
    reach = np.concatenate([[-1], np.maximum.accumulate(base_end)])[before]
    return start[reach <= start], end[reach <= start]


def counts_of(lengths: np.ndarray) -> np.ndarray:
    """Windows over candidates of these lengths with their context."""
    return 1 + -(-np.maximum(lengths + 2 * CONTEXT - WIDTH, 0) // STEP)


def window(text: str, start: int, end: int, i: int = 0) -> bytes:
    """The i-th window over a candidate in its context, WIDTH codes; the top
    bit marks the candidate."""
    a = start - CONTEXT + min(i * STEP, max(0, end - start + 2 * CONTEXT - WIDTH))
    codes = bytearray(WIDTH)
    for i in range(WIDTH):
        p = a + i
        if 0 <= p < len(text):
            c = ord(text[p])
            codes[i] = (c if 0 < c < 127 else 127) | (0x80 if start <= p < end else 0)
    return bytes(codes)


def windows(text: str, start: int, end: int) -> list[bytes]:
    """At most SPREAD windows spread over a finding, with its first and last."""
    n = int(counts_of(np.array([end - start]))[0])
    return [window(text, start, end, i) for i in sorted({round(x) for x in np.linspace(0, n - 1, min(n, SPREAD))})]


class Network:
    """Embedding, convolution, maximum, output; trained with Adam."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"e": r.normal(0, 0.3, (128, EMBED)), "w": r.normal(0, 0.15, (TAPS * (EMBED + 1), FILTERS)),
                  "b": np.zeros(FILTERS), "v": r.normal(0, 0.3, FILTERS), "c": np.zeros(1)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, np.inf
        self.recall = self.precision = None  # on findings written by rule, held out
        self.held = np.zeros((0, 3))  # the table's held-out findings: (output, label, number)
        self.held_recall = self.held_precision = None
        self._m = self._s = None
        self._step = 0

    def weights(self) -> np.ndarray:
        return np.concatenate([v.reshape(-1) for v in self.p.values()])

    def load(self, flat_weights: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat_weights[at:at + v.size].reshape(v.shape).copy()
            at += v.size

    def _forward(self, codes: np.ndarray):
        x = np.concatenate([self.p["e"][codes & 127], (codes >> 7)[..., None].astype(float)], axis=2)
        cols = np.concatenate([x[:, t:WIDTH - TAPS + 1 + t] for t in range(TAPS)], axis=2)
        z = cols @ self.p["w"] + self.p["b"]
        top = z.argmax(axis=1)
        peak = np.take_along_axis(z, top[:, None], axis=1)[:, 0]
        return cols, top, peak, np.maximum(peak, 0) @ self.p["v"] + self.p["c"][0]

    def logits(self, codes: np.ndarray, block: int = 256) -> np.ndarray:
        """Outputs of windows: the convolution as one table of codes a tap."""
        marked = np.concatenate([np.concatenate([self.p["e"], np.full((128, 1), m)], axis=1) for m in (0.0, 1.0)])
        tables = (marked @ self.p["w"].reshape(TAPS, EMBED + 1, FILTERS)).astype(np.float32)
        tables[0] += self.p["b"].astype(np.float32)
        out, places = np.zeros(len(codes)), WIDTH - TAPS + 1
        for i in range(0, len(codes), block):
            part = codes[i:i + block]
            z = tables[0].take(part[:, :places], axis=0)
            for t in range(1, TAPS):
                z += tables[t].take(part[:, t:t + places], axis=0)
            out[i:i + block] = np.maximum(z.max(axis=1), 0) @ self.p["v"] + self.p["c"][0]
        return out

    def largest(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Largest output over each candidate's windows in ``padded`` codes."""
        top = np.full(len(start), -np.inf)
        for of, part, _ in spread(codes, start, end):
            np.maximum.at(top, of, self.logits(part))
        return top

    def score(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Calibrated largest output."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.largest(codes, start, end) + self.shift, -50, 50)))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(codes) + self.shift, -50, 50)))

    def step(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One step of Adam on windows of these labels and weights."""
        if self._m is None:
            self._m = {k: np.zeros_like(v) for k, v in self.p.items()}
            self._s = {k: np.zeros_like(v) for k, v in self.p.items()}
        cols, top, peak, logit = self._forward(codes)
        d = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y) * weight / weight.sum()
        d_peak = d[:, None] * self.p["v"] * (peak > 0)
        used = np.take_along_axis(cols, top[:, :, None], axis=1)  # n x FILTERS x taps
        d_cols = d_peak[:, :, None] * self.p["w"].T[None]
        grad = {"v": np.maximum(peak, 0).T @ d, "c": np.array([d.sum()]), "b": d_peak.sum(axis=0),
                "w": np.einsum("nft,nf->tf", used, d_peak), "e": np.zeros_like(self.p["e"])}
        for t in range(TAPS):
            char = np.take_along_axis(codes & 127, top + t, axis=1)
            np.add.at(grad["e"], char.reshape(-1), d_cols[:, :, t * (EMBED + 1):t * (EMBED + 1) + EMBED].reshape(-1, EMBED))
        self._step += 1
        for k, g in grad.items():
            self._m[k] = 0.9 * self._m[k] + 0.1 * g
            self._s[k] = 0.999 * self._s[k] + 0.001 * g * g
            self.p[k] -= rate * (self._m[k] / (1 - 0.9 ** self._step)) / (np.sqrt(self._s[k] / (1 - 0.999 ** self._step)) + 1e-8)

    def fit(self, codes: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.004) -> None:
        r = np.random.default_rng(3)
        self._m, self._step = None, 0
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(y), batch):
                at = order[i:i + batch]
                self.step(codes[at], y[at], np.ones(len(at)), rate)

    def calibrate(self, codes: np.ndarray, of: np.ndarray, y: np.ndarray, recall: float = RECALL) -> None:
        """Platt scaling of each finding's largest output (``of``: the finding of
        a window) together with those of ``held``, then the highest threshold that
        keeps ``recall`` of ``held``; of all of them and of the given ones while
        ``held`` has too few for such a share."""
        x = np.full(len(y), -np.inf)
        np.maximum.at(x, of, self.logits(codes))
        out, label = np.concatenate([x, self.held[:, 0]]), np.concatenate([y, self.held[:, 1]])
        n = np.concatenate([np.ones(len(y)), self.held[:, 2]])
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton's steps, held back towards 1
            p = 1 / (1 + np.exp(-np.clip(a * out + b, -50, 50)))
            g, h = n * (p - label) / n.sum(), n * p * (1 - p) / n.sum()
            grad = np.array([(g * out).sum() + 1e-3 * (a - 1), g.sum() + 1e-5 * b])
            bend = np.array([[(h * out * out).sum() + 1e-3, (h * out).sum()], [(h * out).sum(), h.sum() + 1e-5]])
            move = np.clip(np.linalg.solve(bend, grad), -0.5, 0.5)
            a, b = max(0.01, a - move[0]), b - move[1]
        self.scale, self.shift = float(a), float(b)
        good = self.held[self.held[:, 1] == 1]
        if good[:, 2].sum() * (1 - recall) >= 1:  # enough of the table's own
            least = _least(good[:, 0], good[:, 2], recall)
        else:
            least = min(_least(x[y == 1], np.ones(int(y.sum())), recall), _least(out[label == 1], n[label == 1], recall))
        self.threshold = float(1 / (1 + np.exp(-np.clip(a * least + b, -50, 50))))
        chosen = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50))) >= self.threshold
        self.recall, self.precision = float(chosen[y == 1].mean()), float(y[chosen].mean())
        kept = self.held[self.held[:, 0] >= least]
        found, all_kept, all_found = (float(t[:, 2].sum()) for t in (kept[kept[:, 1] == 1], kept, self.held[self.held[:, 1] == 1]))
        self.held_recall = found / all_found if all_found else None
        self.held_precision = found / all_kept if all_kept else None


def _least(x: np.ndarray, n: np.ndarray, recall: float) -> float:
    """The largest output that ``recall`` of the findings reach; ``n`` of each."""
    order = np.argsort(x)
    return float(x[order][np.searchsorted(np.cumsum(n[order]), np.floor((1 - recall) * n.sum()), side="right")])


def spread(codes: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = BLOCK):
    """All windows over candidates in ``padded`` codes, in blocks: (candidate,
    codes with the candidate marked, the mark)."""
    counts = counts_of(end - start)
    edges = np.concatenate([[0], np.cumsum(counts)])
    for w in range(0, int(edges[-1]), block):
        at = np.arange(w, min(w + block, edges[-1]))
        of = np.searchsorted(edges, at, side="right") - 1
        a, z = start[of], end[of]
        place = a - CONTEXT + np.minimum((at - edges[of]) * STEP, np.maximum(z - a + 2 * CONTEXT - WIDTH, 0))
        place = place[:, None] + np.arange(WIDTH)
        mark = (place >= a[:, None]) & (place < z[:, None])
        yield of, codes[place] | (mark * 0x80).astype(np.uint8), mark


def is_held(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Findings held out, by their characters."""
    return hash_spans(codes, start, end, seed=23) % np.uint64(HELD) == 0


def _example(label: int, text: str, start: int, end: int) -> tuple[int, bool, bytes]:
    """(label, held out, its windows) of an ASCII text."""
    held = is_held(np.frombuffer(text.encode(), np.uint8), np.array([start]), np.array([end]))[0]
    return label, bool(held), b"".join(windows(text, start, end))


def _labelled(texts: pa.Array):
    """Slices of (``padded`` codes, start, end, label) of all labelled findings."""
    raw, offsets = flat(texts)
    for i, j in slices(offsets, SLICE):
        part, at = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        codes, first = padded(part, at)
        base, values = [], []
        for d in np.flatnonzero(patterned(part, at)).tolist():
            shift, text = int(first[d]), part[at[d]:at[d + 1]].tobytes().decode()
            spans = base_spans(text)
            base += [(a + shift, z + shift) for a, _, z in spans]
            # the value without its keyword
            values += [(m.start(2) + shift, m.end(2) + shift) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
            values += [(a + shift, z + shift) for a, kind, z in spans if kind]
        known, good = np.array(base, np.int64).reshape(-1, 2), np.array(values, np.int64).reshape(-1, 2)
        start, end = extra_spans(codes, known[:, 0], known[:, 1])
        numbers = np.array([m.span() for m in _NUMBER.finditer(codes.tobytes())], np.int64).reshape(-1, 2)
        if len(known) and len(numbers):  # those that touch no base finding
            before = np.searchsorted(known[:, 0], numbers[:, 1])
            numbers = numbers[np.concatenate([[-1], np.maximum.accumulate(known[:, 1])])[before] <= numbers[:, 0]]
        label = np.repeat([1.0, 0.0], [len(good), len(start) + len(numbers)])
        yield codes, np.concatenate([good[:, 0], start, numbers[:, 0]]), np.concatenate([good[:, 1], end, numbers[:, 1]]), label


def _learner(handle, batch: int = 64, rate: float = 0.004):
    """Each task's network after its own findings, as weights times findings."""
    def run(batches):
        net, written = handle.value
        net.load(net.weights())
        net._m, net._step = None, 0
        seen = np.zeros(2)
        codes_, y_, w_, waiting = [], [], [], 0
        for b in batches:
            for codes, start, end, label in _labelled(b.column(0)):
                free = ~is_held(codes, start, end)
                start, end, label = start[free], end[free], label[free]
                seen += np.bincount(label.astype(np.int64), minlength=2)
                each = np.where(label == 1, max(1.0, seen[0] / (PLAIN * max(1.0, seen[1]))), 1.0) / counts_of(end - start)
                for of, part, mark in spread(codes, start, end):
                    y, weight, bare = label[of], each[of], part * mark
                    odd = (y == 0) & (of % 2 == 1)
                    part[odd] = bare[odd]
                    part = np.concatenate([part, bare[y == 1]])
                    y, weight = np.concatenate([y, y[y == 1]]), np.concatenate([weight, weight[y == 1]])
                    near = net.logits(part) * (2 * y - 1) < MARGIN
                    codes_.append(part[near])
                    y_.append(y[near])
                    w_.append(weight[near])
                    waiting += int(near.sum())
                    if waiting >= WAIT:
                        _steps(net, codes_, y_, w_, written, batch, rate)
                        codes_, y_, w_, waiting = [], [], [], 0
        if waiting:
            _steps(net, codes_, y_, w_, written, batch, rate)
        if seen.sum():
            yield pa.RecordBatch.from_arrays([pa.array([seen.sum()]), pa.array([(net.weights() * seen.sum()).tolist()])], ["n", "w"])
    return run


def _steps(net: Network, codes: list, y: list, weight: list, written: tuple, batch: int, rate: float, beside: int = 16) -> None:
    """Steps over these windows, with ``beside`` windows written by rule in each,
    which weigh a quarter of it."""
    codes, y, weight = np.concatenate(codes).astype(np.int64), np.concatenate(y), np.concatenate(weight)
    r = np.random.default_rng(len(y))
    for _ in range(TURNS):
        order = r.permutation(len(y))
        for i in range(0, len(y), batch):
            at = order[i:i + batch]
            more = (np.arange(beside) + net._step * beside) % len(written[1])
            share = np.full(beside, weight[at].sum() / (3 * beside))
            net.step(np.concatenate([codes[at], written[0][more]]), np.concatenate([y[at], written[1][more]]),
                     np.concatenate([weight[at], share]), rate)


def _outputs(handle):
    """Held-out findings of each task, counted by (step of the largest output, label)."""
    def run(batches):
        net = handle.value
        counts = np.zeros(2 * (2 * REACH * BINS + 1), np.int64)
        for b in batches:
            for codes, start, end, label in _labelled(b.column(0)):
                held = is_held(codes, start, end)
                start, end, label = start[held], end[held], label[held].astype(np.int64)
                top = np.full((2, len(start)), -np.inf)
                for of, part, mark in spread(codes, start, end):
                    np.maximum.at(top[0], of, net.logits(part))
                    np.maximum.at(top[1], of, net.logits(part * mark))  # the characters alone
                step = np.clip(np.floor(top * BINS), -REACH * BINS, REACH * BINS).astype(np.int64) + REACH * BINS
                counts += np.bincount((2 * step + label).reshape(-1), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at // 2 - REACH * BINS), pa.array(at % 2), pa.array(counts[at])], ["step", "label", "n"])
    return run


def made(count: int = MADE, seed: int = 5) -> list[tuple[int, int, bytes]]:
    """Examples written by rule: keys of the base patterns' alphabets; words of
    syllables, joined words, paths and numbers."""
    r = np.random.default_rng(seed)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    draw = lambda letters, n: "".join(r.choice(list(letters), n))
    word = lambda n: "".join(draw("bcdfghlmnprstvw", 1) + draw("aeiou", 1) + draw("nrst", int(r.integers(0, 2))) for _ in range(n))
    keys = [lambda: draw(upper + lower + digits, r.integers(16, 49)), lambda: draw(upper + lower + digits + "+/_-", r.integers(20, 65)),
            lambda: "AKIA" + draw(upper + digits, 16), lambda: draw("0123456789abcdef", r.integers(32, 65))]
    plain = [lambda: word(r.integers(3, 7)), lambda: word(4).capitalize(), lambda: word(4).upper(), lambda: f"{word(3)}-{word(2)}",
             lambda: f"/{word(2)}/{word(2)}/{word(3)}", lambda: draw(digits, r.integers(8, 17)), lambda: f"{word(3)}_{draw(digits, 2)}"]
    out = []
    for i in range(count):
        for label, kinds in ((1, keys), (0, plain)):
            value = kinds[i % len(kinds)]()
            before = f"{word(2)} {word(3)} "
            out.append(_example(label, f"{before}{value} {word(2)}", len(before), len(before) + len(value)))
    return out


def train(docs: DataFrame) -> Network:
    """The network fitted on the labelled findings of all documents."""
    spark = docs.sparkSession
    ship(spark)
    net = Network()
    rows = made()
    y = np.array([label for label, _, _ in rows], float)
    held = np.array([side for _, side, _ in rows])
    codes = np.concatenate([np.frombuffer(w, np.uint8) for _, _, w in rows]).reshape(-1, WIDTH).astype(np.int64)
    of = np.repeat(np.arange(len(rows)), [len(w) // WIDTH for _, _, w in rows])
    written = codes[~held[of]], y[of[~held[of]]]
    net.fit(*written, epochs=EPOCHS)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    learned = texts.mapInArrow(_learner(spark.sparkContext.broadcast((net, written))), "n double, w array<double>")
    # one row a weight
    total = learned.select("n", F.posexplode("w").alias("i", "w")).groupBy("i").agg(F.sum("w").alias("w"), F.sum("n").alias("n")) \
        .orderBy("i").collect()
    if total:
        net.load(np.round([r.w / r.n for r in total], 9))
    net._m = net._s = None
    # one row a step of the output and label
    found = texts.mapInArrow(_outputs(spark.sparkContext.broadcast(net)), "step long, label long, n long") \
        .groupBy("step", "label").agg(F.sum("n").alias("n")).orderBy("step", "label").collect()
    net.held = np.array([(r.step / BINS, r.label, r.n) for r in found], float).reshape(-1, 3)
    place = np.cumsum(held) - 1
    net.calibrate(codes[held[of]], place[of[held[of]]], y[held])
    return net


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("score", pa.float64())]))


def _scanner(handle):
    def run(batches):
        net = handle.value
        for b in batches:
            raw, offsets = flat(b.column(1))
            out: list = [[] for _ in range(b.num_rows)]
            for i, j in slices(offsets, SLICE):
                part, at = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                codes, first = padded(part, at)
                base = []
                for d in np.flatnonzero(patterned(part, at)).tolist():
                    shift = int(first[d])
                    base += [(a + shift, k, z + shift) for a, k, z in base_spans(part[at[d]:at[d + 1]].tobytes().decode())]
                known = np.array(base, np.int64).reshape(-1, 3)
                start, end = extra_spans(codes, known[:, 0], known[:, 2])
                kind = np.concatenate([known[:, 1], np.full(len(start), 3)])
                start, end = np.concatenate([known[:, 0], start]), np.concatenate([known[:, 2], end])
                score = net.score(codes, start, end)
                kept = np.flatnonzero((kind < 3) | (score >= net.threshold))
                doc = np.searchsorted(first, start[kept], side="right") - 1
                shift = first[doc]
                for d, a, k, z, s in zip(doc.tolist(), (start[kept] - shift).tolist(), kind[kept].tolist(),
                                         (end[kept] - shift).tolist(), score[kept].tolist()):
                    out[i + d].append((a, k, z, s))
            spans = [[{"start": a, "kind": KINDS[k], "end": z, "score": s} for a, k, z, s in sorted(x)] for x in out]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _SPAN)], ["doc_id", "spans"])
    return run


def scan(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """(doc_id, spans) per document; a span has start, kind, end and the
    network's calibrated score."""
    spark = docs.sparkSession
    ship(spark)
    handle = spark.sparkContext.broadcast(net or train(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _scanner(handle), f"doc_id {kind}, spans array<struct<start:long,kind:string,end:long,score:double>>")


def spans_text(spans, base_only: bool = False):
    """kind:start:end, comma-joined."""
    kept = F.filter(spans, lambda x: x["kind"] != "cnn") if base_only else spans
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
