"""Per-key sequential features (lag, bounded rolling mean, lead) that survive a hot key.

``PARTITION BY account ORDER BY time`` sends all of one account to one task.
Keys above ``heavy_threshold`` rows (there are at most N / threshold of them,
so the set is small by construction) take an exact chunked path instead:

1. position per key: bucketed prefix sums (no whole-key sort) over the order
   columns and the value, ties dealt over salts and equal rows counted, so every
   row has a position of its own and no task holds all rows that tie;
2. chunk = (rn - 1) div ``chunk_rows``; the last ``span`` rows of each chunk
   are copied into the next chunk and the first row into the previous one
   as halo rows;
3. the ordinary window runs per (key, chunk) — at most chunk_rows + span + 1
   rows per task — and halo rows are dropped.

Ties in the order columns are broken by the value on both paths, so rows that
still tie are interchangeable and both paths give the same values. Light keys
use the plain window. One partially aggregated pass over the key column runs
when the plan is built and looks for heavy keys; without any, only the plain
window is planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fjord.functions.exprs import ident
from fjord.operators.prefix import bucket_count, ordered_prefix


def _features(df: DataFrame, part: Sequence[str], order: Sequence[str], value: str, span: int,
              lag_col: str | None, roll_col: str | None, lead_col: str | None) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    cols = []
    if lag_col:
        cols.append(F.lag(value).over(w).alias(lag_col))
    if roll_col:
        cols.append(F.avg(value).over(w.rowsBetween(-span, 0)).alias(roll_col))
    if lead_col:
        cols.append(F.lead(value).over(w).alias(lead_col))
    return df.select("*", *cols)


def positions(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``__pos``: a position of its own (from 0) for every row of a key, in ascending order of ``order``.

    Rows that tie are dealt over as many salts as a shuffle has partitions, by a
    hash of the whole row; the salt is one more order column of the prefix sum.
    Rows that agree in everything are counted instead: they get a run of
    positions and become rows again at the end. So no task holds all rows that
    tie, even where they are most of a key.
    """
    whole = F.xxhash64(*[F.col(ident(c)) for c in df.columns])
    counted = (df.groupBy(*[F.col(ident(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__salt", F.pmod(whole, F.lit(bucket_count(df)))))
    tied = [key, *order, "__salt"]
    totals = counted.groupBy(*tied).agg(F.sum("__n").alias("__n"))
    before = ordered_prefix(totals, [key], [(c, True) for c in tied[1:]], ["__n"])
    before = before.select(*[F.col(c).alias(f"__b_{c}") for c in tied], F.col("__n_before").alias("__before"))
    rows = counted.join(before, [F.col(c).eqNullSafe(F.col(f"__b_{c}")) for c in tied]).select(*counted.columns, "__before")
    earlier = Window.partitionBy(*tied).orderBy(whole).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    rows = rows.withColumn("__first", start)
    return rows.select(*df.columns, F.explode(F.sequence("__first", F.col("__first") + F.col("__n") - 1)).alias("__pos"))


def sequential_features(df: DataFrame, key: str, order: Sequence[str], value: str,
                        lag_col: str | None = "prev_amount", roll_col: str | None = "rolling_avg_amount_7",
                        lead_col: str | None = None, span: int = 6,
                        heavy_threshold: int = 2_000_000, chunk_rows: int = 500_000) -> DataFrame:
    if chunk_rows <= span:
        raise ValueError("chunk_rows must exceed the window span")
    order = [*order, *([value] if value not in order else [])]
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__cnt"))
    heavy = counts.filter(F.col("__cnt") > heavy_threshold).select(key)  # ≤ N / threshold keys
    # one partially aggregated pass over the key column decides the plan: with no
    # heavy key the plain window is already bounded by the threshold per task
    if heavy.isEmpty():
        return _features(df, [key], order, value, span, lag_col, roll_col, lead_col)
    heavy = heavy.select(F.col(key).alias("__heavy"))
    is_heavy = F.col(key).eqNullSafe(F.col("__heavy"))  # NULL is a key like any other
    light = df.join(heavy, is_heavy, "left_anti")
    hot = df.join(heavy, is_heavy, "left_semi")

    light_out = _features(light, [key], order, value, span, lag_col, roll_col, lead_col)

    ranked = positions(hot, key, order).withColumn("__chunk", F.floor(F.col("__pos") / chunk_rows))
    off = F.col("__pos") % chunk_rows
    own = ranked.withColumn("__halo", F.lit(False))
    to_next = ranked.filter(off >= chunk_rows - span) \
                    .withColumn("__chunk", F.col("__chunk") + 1).withColumn("__halo", F.lit(True))
    to_prev = ranked.filter((off == 0) & (F.col("__chunk") > 0)) \
                    .withColumn("__chunk", F.col("__chunk") - 1).withColumn("__halo", F.lit(True))
    halo = own.unionByName(to_next).unionByName(to_prev)
    hot_out = (_features(halo, [key, "__chunk"], ["__pos"], value, span, lag_col, roll_col, lead_col)
               .filter(~F.col("__halo")).drop("__pos", "__chunk", "__halo"))
    return light_out.unionByName(hot_out)
