"""PR curve, AP, best-F1 and report against brute force."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from fjord.operators import metrics

TIED = [(1, .9), (0, .9), (1, .8), (0, .4), (1, .4), (0, .1)]


def brute(rows):
    """Reference semantics: one point per distinct score, descending."""
    P = sum(y for y, _ in rows)
    pts = []
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        prec = tp / (tp + fp)
        rec = tp / P if P else None
        pts.append((t, prec, rec))
    ap = None
    if P:
        ap, prev = 0.0, 0.0
        for _, p, r in pts:
            ap += (r - prev) * p
            prev = r
    best = None
    if P:
        f1s = [(2 * p * r / max(p + r, 1e-12), t) for t, p, r in pts]
        m = max(f for f, _ in f1s)
        best = (min(t for f, t in f1s if f == m), m)
    return pts, ap, best


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_tied_scores(spark):
    df = frame(spark, TIED)
    curve = metrics.pr_curve(df)
    ap = metrics.average_precision(curve).first()[0]
    assert math.isclose(ap, 0.588888888, rel_tol=1e-6)
    b = metrics.best_f1_threshold(curve).first()
    assert math.isclose(b["threshold"], 0.4) and math.isclose(b["f1"], 0.75)
    assert curve.count() == 4


def test_no_positives_and_empty(spark):
    neg = frame(spark, [(0, .3), (0, .7)])
    curve = metrics.pr_curve(neg)
    assert metrics.average_precision(curve).first()[0] is None
    assert metrics.best_f1_threshold(curve).first()["threshold"] == 0.5
    empty = frame(spark, [])
    assert metrics.best_f1_threshold(metrics.pr_curve(empty)).first()["threshold"] == 0.5
    allpos = frame(spark, [(1, .3), (1, .7)])
    assert math.isclose(metrics.average_precision(metrics.pr_curve(allpos)).first()[0], 1.0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([.1, .2, .3, .5, .8, .9])), min_size=1, max_size=30))
def test_against_brute_force(spark, rows):
    df = frame(spark, rows)
    curve = metrics.pr_curve(df, buckets=4)
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in curve.collect()}
    pts, ap, best = brute(rows)
    assert set(got) == {t for t, _, _ in pts}
    for t, p, r in pts:
        assert math.isclose(got[t][0], p)
        assert (got[t][1] is None) == (r is None) and (r is None or math.isclose(got[t][1], r))
    got_ap = metrics.average_precision(curve).first()[0]
    assert (got_ap is None) == (ap is None) and (ap is None or math.isclose(got_ap, ap))
    b = metrics.best_f1_threshold(curve).first()
    if best is None:
        assert b["threshold"] == 0.5
    else:
        assert math.isclose(b["threshold"], best[0]) and math.isclose(b["f1"], best[1])


def test_confusion_and_report(spark):
    df = frame(spark, TIED)
    cm = {(r["actual"], r["predicted"]): r["row_count"] for r in metrics.confusion_matrix(df, threshold=0.5).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    rep = {r["label"]: r for r in metrics.classification_report(df, threshold=0.5).collect()}
    assert math.isclose(rep["1"]["precision"], 2 / 3) and math.isclose(rep["1"]["recall"], 2 / 3)
    assert math.isclose(rep["accuracy"]["f1_score"], 4 / 6)
    assert rep["macro avg"]["support"] == 6
