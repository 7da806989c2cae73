"""Binary-classifier metrics as DataFrame aggregates.

Everything starts from one row per *distinct* score (tied scores form one PR
point). Cumulative counts in descending score order come from
``ordered_prefix``, so even with one distinct score per row no single task
sorts the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.operators.prefix import ordered_prefix

_EPS = 1e-12  # the reference's floor on precision + recall in the F1 denominator


def pr_curve(df: DataFrame, label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """One (threshold, tp, fp, precision, recall) row per distinct score.

    Row for threshold t counts rows with score >= t. The extra (P=1, R=0)
    end point has no threshold and is not emitted. Recall is NULL when there
    are no positives.
    """
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    cum = ordered_prefix(per_score.filter(F.col("threshold").isNotNull()), [],
                         [("threshold", False)], ["pos", "neg"], buckets=buckets)
    tp, fp, p = F.col("pos_through"), F.col("neg_through"), F.col("pos_total")
    return cum.select(
        "threshold", "pos", "neg",
        tp.alias("tp"), fp.alias("fp"),
        (tp / (tp + fp)).cast("double").alias("precision"),
        F.when(p > 0, tp / p).cast("double").alias("recall"),
    )


def with_f1(curve: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return curve.withColumn("f1", (2 * p * r) / F.greatest(p + r, F.lit(_EPS)))


def average_precision(curve: DataFrame) -> DataFrame:
    """Σ (Rₙ − Rₙ₋₁)·Pₙ = Σ pos·precision / P — a plain aggregate, no lag."""
    return curve.agg(
        (F.sum(F.col("pos") * F.col("precision")) / F.nullif(F.sum("pos"), F.lit(0)))
        .cast("double").alias("average_precision"))


def best_f1_threshold(curve: DataFrame, default: float = 0.5) -> DataFrame:
    """A14 + L6: threshold of the highest F1, lowest threshold on ties; 0.5 if none."""
    c = with_f1(curve).filter(F.col("f1").isNotNull())
    best = c.agg(F.max_by(F.struct("threshold", "f1"),
                          F.struct(F.col("f1"), -F.col("threshold"))).alias("b"))
    return best.select(F.coalesce(F.col("b.threshold"), F.lit(default)).cast("double").alias("threshold"),
                       F.col("b.f1").cast("double").alias("f1"))


def confusion_counts(df: DataFrame, label: str, score: str, threshold) -> DataFrame:
    """P17 + A15: the four cells in one aggregate pass (prediction = score >= t)."""
    t = threshold if hasattr(threshold, "alias") else F.lit(threshold)
    pred = (F.col(score) >= t).cast("int")
    y = F.col(label)
    return df.agg(
        F.count_if((y == 0) & (pred == 0)).alias("tn"),
        F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"),
        F.count_if((y == 1) & (pred == 1)).alias("tp"))


def confusion_matrix(df: DataFrame, label: str = "label", score: str = "score", threshold=0.5) -> DataFrame:
    """Rows (actual, predicted, count), all four cells even when zero."""
    cells = confusion_counts(df, label, score, threshold)
    return cells.selectExpr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, row_count)")


def classification_report(df: DataFrame, label: str = "label", score: str = "score", threshold=0.5) -> DataFrame:
    """Per-class precision/recall/F1/support, macro and weighted averages, accuracy.

    Zero denominators give 0.0 (the reference's zero-division default).
    """
    c = confusion_counts(df, label, score, threshold)

    def div(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")

    def f1(p, r):
        return F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))

    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    m = c.select(
        div(tn, tn + fn).alias("p0"), div(tn, s0).alias("r0"),
        div(tp, tp + fp).alias("p1"), div(tp, s1).alias("r1"),
        s0.alias("s0"), s1.alias("s1"), n.alias("n"), div(tn + tp, n).alias("acc"))
    m = m.withColumn("f0", f1(F.col("p0"), F.col("r0"))).withColumn("f1", f1(F.col("p1"), F.col("r1")))
    return m.selectExpr(
        "stack(5,"
        " '0', p0, r0, f0, s0,"
        " '1', p1, r1, f1, s1,"
        " 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n,"
        " 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n,"
        " 'weighted avg', IF(n > 0, (p0 * s0 + p1 * s1) / n, 0D), IF(n > 0, (r0 * s0 + r1 * s1) / n, 0D),"
        "   IF(n > 0, (f0 * s0 + f1 * s1) / n, 0D), n"
        ") AS (label, precision, recall, f1_score, support)")
