"""Host rules, hard negatives and whitening against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fjord.llm import hardneg, hostrules, whitening
from fjord.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_measure(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(runs)
    inside = {j for i, r in enumerate(runs) if often[r] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(lines))


def plain_hosts(found, limit=0.5, margin=2.0):
    """{host: (worst rate, failed)} of rows (host, measures)."""
    rules = [lambda n, c, s, d, r, x: n < 10, lambda n, c, s, d, r, x: 100 * r > 20 * n, lambda n, c, s, d, r, x: 100 * d > 30 * x,
             lambda n, c, s, d, r, x: 100 * s > 10 * n, lambda n, c, s, d, r, x: c < 3 * n or c > 12 * n]
    size, out = Counter(h for h, _ in found), {}
    total, hosts = len(found), len(size)
    for rule in rules:
        fails = Counter(h for h, m in found if rule(*m))
        mean = sum(fails.values()) / total
        room = total - sum(n * n for n in size.values()) / total - (hosts - 1)
        alike = 0.0
        if 0 < mean < 1 and room > 1e-9 * total:
            between = (sum(fails[h] ** 2 / n for h, n in size.items()) - total * mean * mean) / (mean * (1 - mean)) - (hosts - 1)
            alike = between / room
        alike = min(max(alike, 1e-6), 1 - 1e-6)
        a = (1 - alike) / alike
        for h, n in size.items():
            rate = (mean * a + fails[h]) / (a + n)
            low = rate - margin * math.sqrt(rate * (1 - rate) / (a + n + 1))
            worst, failed = out.get(h, (0.0, False))
            out[h] = (max(worst, rate), failed or low > limit)
    return out


TEXTS = [None, "", "one", "a b c d e a b c d e x y", "a a a a a a", "a a a a a", "x\n\nx\n x\nx", " b c d\u0085e " * 3, "é日 #$% <b>|&*\r\n" * 4,
         "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", " \t\v\f\r\n", "w1 w2 w3 w4 w5 z w1 w2 w3 w4 w5 w1 w2 w3 w4 q r s t u v"]


def test_measures():
    for t in TEXTS:
        assert hostrules.measure(t) == plain_measure(t), repr(t)
    rng = np.random.default_rng(3)
    for _ in range(200):
        t = "".join(rng.choice(["a", "b", "cc", "é"]) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.integers(0, 60)))
        assert hostrules.measure(t) == plain_measure(t), repr(t)


def test_measures_of_pieces(monkeypatch):
    monkeypatch.setattr(hostrules, "PIECE", 3)  # cuts between words, never inside one
    for t in TEXTS:
        assert hostrules.measure(t) == plain_measure(t), repr(t)


def test_bad_hosts_fall_and_clean_ones_stay(spark):
    good, bad = " ".join(f"word{i}" for i in range(40)), "same five words again here " * 30
    rows = [(i, good if i % 20 else bad, f"host{i % 8}") for i in range(800)]
    rows += [(1000 + i, bad if i % 10 else good, "farm") for i in range(100)]
    rows += [(2000, bad, "tiny"), (2001, good, None), (2002, None, None), (2003, good, "https://Farm.example/x"), (2003, good, "host1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"host": F.lit(1), "n_words": F.lit(2)})
    out = {(r.doc_id, r.host): r for r in hostrules.judge(docs.repartition(5)).collect()}
    assert len(out) == len(rows) and out[2003, "farm.example"].kept
    assert not any(r.kept for (i, h), r in out.items() if h == "farm") and out[1000, "farm"].host_failed
    assert out[1010, "farm"].base_failed is False  # a clean page falls with its host
    assert all(r.kept == (not r.base_failed) for (i, h), r in out.items() if h != "farm")
    assert out[2000, "tiny"].host_rate < 0.9 < plain_hosts([("t", plain_measure(bad))])["t"][0]  # one page is pulled to the mean of all hosts
    want = plain_hosts([(r.host, tuple(r[m] for m in hostrules.MEASURES)) for r in out.values()])
    for (_, h), r in out.items():
        assert (r.host_rate, r.host_failed) == (pytest.approx(want[h][0], rel=1e-9), want[h][1])
    assert hostrules.judge(docs.limit(0)).count() == 0
    assert hostrules.judge(docs.drop("source")).filter("host = '(none)'").count() == len(rows)


def test_rules_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    found = {r.doc_id: plain_measure(r.text) for r in docs}
    hosts = plain_hosts([(r.source, found[r.doc_id]) for r in docs])
    source = {r.doc_id: r.source for r in docs}
    got = QUERIES["op11_host_rules"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        m = found[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m[:5]
        assert r.base_failed == (m[0] < 10 or 100 * m[4] > 20 * m[0])
        assert r.kept == (not r.base_failed and not hosts[source[r.doc_id]][1])


def plain_mine(rows, is_anchor, k_pos, k_neg, low=30, high=90):
    """Sorted rows of the result; rows (id, label, vector)."""
    good = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, y, v in rows
            if i is not None and y is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 2**45 for x in v)]
    good = [g for g in good if sum(x * x for x in g[2]) < 2**62]
    out = []
    for a, (i, y, v) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = [(-sum(p * q for p, q in zip(v, w, strict=True)), j, z) for b, (j, z, w) in enumerate(good) if b != a and len(w) == len(v)]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2] == y][:k_pos]:
            fits = [(n, m) for n, m, z in scored if z != y and low * -p <= 100 * -n <= high * -p][:k_neg]
            out += [(i, j, r + 1, m, -p, -n) for r, (n, m) in enumerate(fits)]
    return sorted(out)


def test_hard_negatives(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = [(i, int(rng.integers(4)), (centres[rng.integers(6)] + 0.6 * rng.normal(size=12)).tolist()) for i in range(500)]
    rows += [(500 + i, i % 3, rows[i % 7][2]) for i in range(60)]  # ties
    rows += [(600, 1, None), (610, None, [1.0] * 12), (620, 1, []), (630, 1, [float("nan")] * 12), (640, 1, [None] + [1.0] * 11),
             (650, 1, [float("inf")] + [1.0] * 11), (660, 1, [0.0] * 12), (670, 1, [1e200] * 12), (680, 2, [1e9] * 12), (690, 1, [1.0, 2.0]),
             (700, 1, [2.0, 1.5]), (710, 2, [1.0, 1.0]), (None, 1, [1.0] * 12), (720, 1, [0.5] * 12), (720, 1, [0.5] * 12),
             (720, 2, [0.4] * 12), (730, 9, [3.0] * 12), (740, 1, [-0.5] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {"x": F.lit(1), "id": F.lit("z"), "u": F.lit(0), "norm": F.lit(0), "cell": F.lit(0)})
    want = plain_mine(rows, lambda i: i % 10 == 0, 3, 4)
    for blocks, stripes in ((None, 1_000_000), (7, 60)):
        got = hardneg.mine(df.repartition(5), F.col("id") % 10 == 0, positives=3, negatives=4, block_rows=blocks, stripe_rows=stripes)
        assert sorted(map(tuple, got.collect())) == want
    assert hardneg.mine(df.limit(0), F.col("id") % 10 == 0).count() == 0


def some_rows(vectors, labels, refs, ids=None):
    norms = np.linalg.norm(vectors.astype(float), axis=1)
    u = np.arange(len(vectors))
    return hardneg.Rows(u, u if ids is None else ids, labels, vectors, norms, hardneg.angles(vectors.astype(float), norms, refs))


def test_bounds_hold_and_spare_work_on_clusters():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 32)) * 300
    v = np.floor(centres[rng.integers(8, size=3000)] + 20 * rng.normal(size=(3000, 32))).astype(np.int64)
    v[:5] = v[5:10] * 3  # the same direction
    v[10] = 0
    refs = hardneg.directions(v[:1000].astype(float))
    rows = some_rows(v, rng.integers(3, size=len(v)), refs)
    order = np.lexsort((rows.angles.min(axis=1), rows.angles.argmin(axis=1)))
    rows, anchors = rows.take(order), rows.take(slice(0, 200))
    exact = anchors.vectors @ rows.vectors.T
    low, high = hardneg.pair_bounds(anchors, rows)
    assert (low <= exact).all() and (exact <= high).all()
    skipped = 0
    for at in range(0, len(v), 250):
        t = rows.take(slice(at, at + 250))
        a, b = hardneg.tile_bounds(anchors, t.angles.min(axis=0), t.angles.max(axis=0), t.norms.min(), t.norms.max())
        assert (a <= exact[:, at:at + 250].min(axis=1)).all() and (b >= exact[:, at:at + 250].max(axis=1)).all()
        skipped += (b < 0.8 * exact.max(axis=1)).mean() / 12
    assert skipped > 0.4
    assert (high < 0.8 * exact.max(axis=1)[:, None]).mean() > 0.5


def test_hard_negatives_query(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, SF_SMALL).collect())) == plain_mine(rows, lambda i: i % 100 == 0, 5, 10)


def plain_whiten(rows, components=4):
    """{(id, place): ...} by numpy's eigh on the covariance of the distinct vectors."""
    x = {i: np.floor(256 * np.array(v, np.float64)) for i, v in enumerate(rows)}
    fit = np.unique(np.array(list(x.values())), axis=0)
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    sums = [int(s) for s in fit.sum(axis=0)]
    deviation = {i: sum((len(fit) * int(a) - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}
    z = {i: (v - fit.mean(axis=0)) @ vectors / np.sqrt(values) for i, v in x.items()}
    return len(fit), deviation, z, values / (centred**2).sum() * len(fit)


def check_whitened(got, rows):
    n, deviation, z, explained = plain_whiten(rows)
    assert len(got) == len(rows) * 4
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(1, 5):
        sign = math.copysign(1, by[0, c].whitened * z[0][c - 1])
        for i in range(len(rows)):
            r = by[i, c]
            assert (r.n, r.deviation) == (n, deviation[i])
            assert r.whitened * sign == pytest.approx(z[i][c - 1], abs=1e-9)
            assert r.explained == pytest.approx(explained[c - 1], rel=1e-10) and r.identity_error < 1e-10


def test_whitening_query(spark):
    rows = [r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    check_whitened(QUERIES["op13_whitening"](spark, SF_SMALL).collect(), rows)


def test_whitening_odd_tables(spark):
    rng = np.random.default_rng(6)
    rows = (rng.normal(size=(150, 7)) * [9, 5, 4, 3, 1, 0.5, 0.1] + 3).tolist()
    rows += rows[:1] * 300  # one vector holds most rows
    odd = [(900, None), (901, []), (902, [float("nan")] * 7), (903, [None] + [1.0] * 6), (904, [float("inf")] * 7), (905, [1.0, 2.0]), (906, [1e200] * 7)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)] + odd, "vec_id long, embedding array<double>").withColumns(
        {"x": F.lit(1), "id": F.lit("z"), "n": F.lit(0)})
    check_whitened(whitening.whiten(df.repartition(5)).collect(), rows)
    assert whitening.whiten(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(one).count() == 0  # no variance
    line = spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 6.0]), (1, [5.0, 10.0]), (2, [2.0**44, 2.0**44])], "vec_id long, embedding array<double>")
    out = whitening.whiten(line.filter("vec_id is null or vec_id = 1")).collect()
    assert sorted((r.vec_id or 0, r.component, round(r.whitened, 9)) for r in out) == [(0, 1, 0.0), (1, 1, -1.224744871), (1, 1, 1.224744871)]
    assert {r.deviation is None for r in whitening.whiten(line).collect()} == {True}  # beyond 64 bits


def test_eigenpairs_of_hard_spectra():
    rng = np.random.default_rng(8)
    for values in ([5.0] * 3 + [1.0] * 57, np.linspace(1, 1.01, 90), np.geomspace(1, 1e-14, 50), [3.0, 2.0, 1.0], [1.0] * 30):
        values = np.sort(np.array(values))[::-1]
        q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0]
        a = (q * values) @ q.T
        got, vectors = whitening.eigenpairs(lambda b, a=a: a @ b, len(values), min(4, len(values)))
        assert got == pytest.approx(values[:len(got)], rel=1e-12, abs=1e-13)
        assert np.abs(a @ vectors - vectors * got).max() < 1e-12 and np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
