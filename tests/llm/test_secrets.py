from __future__ import annotations

import hashlib
import re

import numpy as np

from blotter.llm import secrets as S
from blotter.llm.catalog import QUERIES

from .conftest import SF_MID, docs_of


def base(text):
    out = []
    for k, (name, pattern, least, flags) in enumerate([
            ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, re.I | re.A),
            ("access", r"(A)(KIA[A-Z0-9]+)", 15, 0), ("hex", r"()([0-9a-f]+)", 32, 0)]):
        out += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "", flags) if len(m.group(2)) >= least]
    return [x for *_, x in sorted(out)]


def check(rows, got):
    for i, text in rows:
        r = next(g for g in got if g.doc_id == i)
        want = base(text)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (i, want, r.spans)
        assert [x for x in r.spans.split(",") if x and not x.startswith("cnn")] == want
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex"))
        assert r.n_cnn == sum(x.startswith("cnn") for x in r.spans.split(","))


def test_whole_small_table_against_the_patterns(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    got = QUERIES["op7_secret_scan"](spark, SF_MID).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_odd_texts(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "tOken:secret:abcdefghij ſecret=abcdefghij"), (4, "é😀 PASSWORD = 'abc/def+ghi=' x"), (5, "api_key:1234567"),
            (6, "AKIA0000AKIA0000 AKIAabc AKIA12345678901"), (7, "a" * 31 + " " + "f" * 32 + "g" + "0" * 40), (8, "password=" + "x" * 100000),
            (9, "word " * 50000), (10, "passwd\n=abcdefghij apikey='" + "deadbeef" * 5 + "'")]
    got = S.scan(docs_of(spark, rows).selectExpr("*", "1 as spans"), S.Network())
    count = lambda k: S.F.size(S.F.filter("spans", lambda x: x["kind"] == k)).alias(f"n_{k}")
    got = got.select("doc_id", *map(count, S.KINDS),
                     S.F.sha2(S.spans_text(S.F.col("spans"), True), 256).alias("base_sha256"), S.spans_text(S.F.col("spans")).alias("spans"))
    check(rows, got.collect())
    assert S.scan(docs_of(spark, [])).count() == 0


def test_network_learns_and_adds_spans(spark):
    rnd = np.random.default_rng(0)
    chars = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    word = lambda: "".join(rnd.choice(chars[:26], rnd.integers(3, 12)))
    key = lambda n: "".join(rnd.choice(chars, n))
    rows = []
    for i in range(400):
        words = [word() for _ in range(30)]
        if i % 2:
            words.insert(15, f"password={key(24)}")
        rows.append((i, " ".join(words)))
    docs = docs_of(spark, rows)
    net = S.train(docs)
    codes = lambda texts: np.array([list(S.window(t, a, z)) for t, a, z in texts], np.uint8).astype(np.int64)
    good = codes([(f"the key is {k}", 11, 35) for k in (key(24) for _ in range(50))])
    plain = codes([(f"{word()} {w} {word()}", 0, 5) for w in (word() for _ in range(50))])
    assert net.probability(good).mean() > 0.5 > 0.2 > net.probability(plain).mean()
    with_secret = S.scan(docs_of(spark, [(1, f"the password={key(24)} and q {key(24)}9x8 end"), (2, "only plain words here")]), net).collect()
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in with_secret}
    assert kinds[1] == ["assign", "cnn"] and kinds[2] == []
    assert net.recall >= S.RECALL and net.precision >= 0.9


def test_few_findings_still_give_a_network(spark):
    rnd = np.random.default_rng(4)
    key = "".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 40))
    text = f"see the other one {key} right here with ordinary neighbours"
    for rows in ([], [(1, "password=abcdefgh12 and more words")]):
        net = S.train(docs_of(spark, rows))
        assert np.isfinite(net.threshold)
        (r,) = S.scan(docs_of(spark, [(1, text)]), net).collect()
        assert [(s.kind, s.start, s.end) for s in r.spans] == [("cnn", 18, 58)]


def test_findings_are_held_out_whole(spark, monkeypatch):
    """No held-out finding's characters are trained on, and the threshold keeps
    RECALL of the largest outputs that the scan would take."""
    seen = {}
    fit, calibrate = S.Network.fit, S.Network.calibrate
    monkeypatch.setattr(S.Network, "fit", lambda self, codes, y, **k: (seen.update(fit=(codes, y)), fit(self, codes, y, **k))[1])
    monkeypatch.setattr(S.Network, "calibrate", lambda self, codes, of, y: (seen.update(held=(codes, of, y)), calibrate(self, codes, of, y))[1])
    net = S.train(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    marked = lambda w: bytes(c & 0x7F for c in w if c & 0x80)
    codes, of, y = seen["held"]
    trained = {marked(w) for w, label in zip(seen["fit"][0].tolist(), seen["fit"][1]) if label == 1}
    held = [marked(w) for w, i in zip(codes.tolist(), of) if y[i] == 1]
    assert held and not trained & {w for w in held if len(w) > 8}
    assert sorted(set(of.tolist())) == list(range(len(y)))
    best = np.array([net.probability(codes[of == i]).max() for i in np.flatnonzero(y == 1)])
    assert (best >= net.threshold).mean() >= S.RECALL and abs((best >= net.threshold).mean() - net.recall) < 1e-9


def test_gradients():
    net = S.Network(1)
    rnd = np.random.default_rng(2)
    codes = rnd.integers(0, 256, (8, S.WIDTH))
    y = rnd.integers(0, 2, 8).astype(float)
    loss = lambda: float(np.mean(np.logaddexp(0, net._forward(codes)[3]) - y * net._forward(codes)[3]))
    before = loss()
    net.fit(codes, y, epochs=30, batch=8, rate=0.01)
    assert loss() < before / 2


def test_long_and_letter_only_candidates_are_read_whole(spark):
    net = S.Network()
    net.threshold = 0.0
    key = "Zq8" * 66 + "Xy"
    texts = ["see /srv/app/config/releases/current/" + "aB3xK9" * 4 + " there", f"é {key} end", "the onlylettersinhere token short"]
    docs = docs_of(spark, list(enumerate(texts)))
    got = {r.doc_id: [(s.start, s.end, s.score) for s in r.spans] for r in S.scan(docs, net).collect()}
    assert [[x[:2] for x in got[i]] for i in range(3)] == [[(4, 61)], [(2, 202)], [(4, 21)]]
    for i, text in enumerate(texts):
        a, z, score = got[i][0]
        n = S.counts_of(np.array([z - a]))[0]
        codes = np.array([list(S.window(text, a, z, k)) for k in range(n)])
        assert abs(score - max(net.probability(codes))) < 1e-9
        seen = {p for k in range(n) for p in range(*(lambda s: (s, s + S.WIDTH))(a - 20 + min(k * S.STEP, max(0, z - a - 24))))}
        assert seen >= set(range(a - 20, z + 20))


def test_a_secret_behind_a_long_path_scores_like_the_secret():
    rnd = np.random.default_rng(1)
    net = S.Network(3)
    marks = np.array([c | 0x80 for c in b"Q7"])
    codes = rnd.integers(97, 123, (400, S.WIDTH)) | 0x80
    y = (np.arange(400) % 2).astype(float)
    codes[y == 1, 30:32] = marks
    net.fit(codes, y)
    plain, behind = b"/srv/app/config/releases/current" * 3, b"/srv/app/config/releases/current" * 3 + b"Q7ab"
    score = lambda t: net.score(S.padded(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0], np.array([S.WIDTH]), np.array([S.WIDTH + len(t)]))[0]
    assert score(behind) > 0.5 > score(plain)


def test_training_reads_every_document(spark):
    """Any document's finding counts: trained on or held out, whatever its doc_id,
    its place in the text and the number of ordinary candidates before it."""
    plain = " ".join(["ordinaryword"] * 40)
    rows = [(i, f"{plain} api_key={i:04d}abcdEFGHijklMNOP") for i in range(1200)] + [(None, "password=Zz9Yy8Xx7Ww6Vv5")]
    net = S.train(docs_of(spark, rows).repartition(5))
    held = {label: int(net.held[net.held[:, 1] == label][:, 2].sum()) for label in (0, 1)}
    values = [f"{i:04d}abcdEFGHijklMNOP" for i in range(1200)] + ["Zz9Yy8Xx7Ww6Vv5"]
    side = lambda v: bool(S.is_held(np.frombuffer(v.encode(), np.uint8), np.array([0]), np.array([len(v)]))[0])
    assert held[1] == 2 * sum(map(side, values)) > 400  # in context and without
    assert held[0] == 2 * 40 * 1200 * side("ordinaryword")
    assert net.held_recall >= S.RECALL
