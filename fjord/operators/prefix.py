"""Ordered prefix sums and ranks that do not put a whole group in one task.

A SQL window ``PARTITION BY g ORDER BY v`` sends every row of group ``g`` to a
single task. When the group is a calendar day (W3/W4), the whole table (W5, PR
curve) or a heavy account, that task holds a large share of the data. Here
the same numbers come from three bounded steps:

1. split the order values into ranges: a uniform sample of about ``PER_POINT``
   rows for each of ``buckets`` split points over all groups, of which every
   ``PER_POINT``-th of a group becomes a split point. So points are dealt over
   groups in proportion to their rows, a small group has none, and the split
   table is bounded by ``buckets``, however many groups there are;
2. total the weights per (group, bucket) and prefix-sum those totals — a table
   of at most groups + buckets rows;
3. prefix-sum inside each (group, bucket) with an ordinary window, and add the
   bucket offset.

Equal leading order values always fall in the same bucket, so ties never cross
a bucket boundary and SQL ``rank`` semantics are exact. Callers pass rows that
are distinct on (keys, order columns); ``group_rank`` does that aggregation
first, which also collapses a hot repeated value to one row before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "__bucket"
STEP = 64
PER_POINT = 50  # sampled rows per split point: a range holds this often its share of the rows, give or take a seventh
_HASHES = 1 << 40


def bucket_count(df: DataFrame) -> int:
    """As many ranges as a shuffle has partitions: the cluster's own measure of how finely to deal work."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _order_expr(name: str, ascending: bool) -> Column:
    c = F.col(name)
    return c.asc_nulls_first() if ascending else c.desc_nulls_last()


def _as_number(df: DataFrame, name: str) -> Column:
    """An order-preserving double for the bucketing column (timestamps as microseconds)."""
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, T.TimestampType):  # an instant: micros since the epoch are monotonic
        return F.unix_micros(c).cast("double")
    if isinstance(t, T.TimestampNTZType):  # wall-clock: difference to the epoch, no time zone involved
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)").cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def split_points(df: DataFrame, keys: Sequence[str], lead: Column, order: Sequence[str], weights: Sequence[str],
                 buckets: int) -> DataFrame:
    """(keys, __splits): a group's split points of ``lead``, sorted; about ``buckets`` over all groups, none for small ones.

    Any points give right sums; these make ranges of like size. The count and
    the sample read the weights too, so that both share the shuffle ``df`` ends with.
    """
    some = F.lit(True)
    for w in weights:
        some = some & (F.col(w).cast("double") > float("-inf"))
    rows = df.agg(F.count_if(some)).scalar()
    hashed = F.pmod(F.xxhash64(*[F.col(c) for c in [*keys, *order, *weights]]), F.lit(_HASHES))
    sample = df.filter(lead.isNotNull() & (hashed < F.lit(float(PER_POINT) * buckets * _HASHES) / rows))
    values = F.array_sort(F.collect_list(lead))  # at most about PER_POINT x buckets over all groups
    points = sample.groupBy(*keys).agg(values.alias("__v"))
    thinned = F.transform(F.filter(F.transform("__v", lambda v, i: F.struct(v.alias("v"), i.alias("i"))),
                                   lambda e: e["i"] % PER_POINT == PER_POINT - 1), lambda e: e["v"])
    return points.select(*keys, thinned.alias("__splits")).filter(F.size("__splits") > 0)


def ordered_prefix(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    weights: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Add ``<w>_before`` / ``<w>_through`` and ``<w>_total`` for every weight.

    ``<w>_before`` sums the weights of rows strictly earlier in the order within
    the same key group, ``<w>_through`` includes the row itself. Rows must be
    distinct on ``keys`` + order columns. The leading order column must be
    numeric (it is bucketed); later ones only break ties inside a bucket.

    Shuffles: one small one for the split points, one on (keys, bucket) for the
    local prefix; bucket totals come out of that same window, and the offsets
    table (groups + buckets rows) is broadcast by AQE once its size is known.
    """
    keys = list(keys)
    lead, lead_asc = order[0]
    lead_d = _as_number(df, lead)
    buckets = buckets or bucket_count(df)
    splits = split_points(df, keys, lead_d, [c for c, _ in order], weights, buckets)
    # sorted the way the bucket numbers run, and every STEP-th point apart: a row looks at two short lists
    splits = splits.withColumn("__splits", F.sort_array("__splits", asc=lead_asc))
    coarse = F.transform(F.filter(F.transform("__splits", lambda s, i: F.struct(s.alias("s"), i.alias("i"))),
                                  lambda e: e["i"] % STEP == STEP - 1), lambda e: e["s"])
    splits = splits.select(*keys, F.struct("__splits", coarse.alias("__coarse")).alias("__splits"))

    def passed(points: Column) -> Column:
        return F.size(F.filter(points, (lambda s: s < lead_d) if lead_asc else (lambda s: s > lead_d)))

    first = passed(F.col("__splits.__coarse")) * STEP
    below = first + passed(F.slice(F.col("__splits.__splits"), first + 1, F.lit(STEP)))
    last = F.size(F.col("__splits.__splits"))
    bucket = F.when(F.col("__splits").isNull(), F.lit(0)).when(lead_d.isNull(), F.lit(0) if lead_asc else last).otherwise(below)
    bucket = F.coalesce(bucket, F.lit(0))  # never NULL, and the planner knows: no filter on it is pushed to the scan
    # One row per group that has split points; with no keys it is a single scalar.
    if keys:  # NULL is a group too: join NULL-safely
        splits = splits.select(*[F.col(k).alias(f"__s_{k}") for k in keys], "__splits")
        joined = df.join(splits, [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys], "left") \
            .drop(*[f"__s_{k}" for k in keys])
    else:  # one global row: a scalar subquery, no join
        joined = df.withColumn("__splits", splits.scalar())
    tagged = joined.withColumn(_BUCKET, bucket).drop("__splits")

    part = Window.partitionBy(*keys, _BUCKET)
    wb = part.orderBy(*[_order_expr(c, a) for c, a in order]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.select(
        "*",
        *[F.sum(w).over(wb).alias(f"__loc_{w}") for w in weights],
        *[F.sum(w).over(part).alias(f"__bt_{w}") for w in weights],
    )
    totals = local.groupBy(*keys, _BUCKET).agg(*[F.max(f"__bt_{w}").alias(f"__bt_{w}") for w in weights])
    wk = Window.partitionBy(*keys).orderBy(_BUCKET)
    offsets = totals.select(
        *[F.col(k).alias(f"__o_{k}") for k in keys], F.col(_BUCKET).alias("__o_bucket"),
        *[F.coalesce(F.sum(f"__bt_{w}").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
          .alias(f"__off_{w}") for w in weights],
        *[F.sum(f"__bt_{w}").over(Window.partitionBy(*keys)).alias(f"{w}_total") for w in weights],
    )
    cond = [F.col(k).eqNullSafe(F.col(f"__o_{k}")) for k in keys] + [F.col(_BUCKET) == F.col("__o_bucket")]
    out = local.join(offsets, cond, "inner")
    cols = list(df.columns)
    for w in weights:
        out = out.withColumn(f"{w}_through", F.col(f"__off_{w}") + F.col(f"__loc_{w}"))
        out = out.withColumn(f"{w}_before", F.col(f"{w}_through") - F.col(w))
    return out.select(*cols, *[f"{w}_{s}" for w in weights for s in ("before", "through", "total")])


def group_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    outputs: dict[str, str],
    buckets: int | None = None,
) -> DataFrame:
    """SQL ``rank()`` / ``percent_rank()`` over (keys, order) for every row of ``df``.

    Ranks are ``bigint``: one group (a day, the whole table) can exceed 2^31
    rows at scale, where an ``int`` rank would overflow.

    ``outputs`` maps a new column name to ``rank``, ``percent_rank``,
    ``rank_reverse``, ``percent_rank_reverse`` or ``count`` (group size); the reverse kinds rank by the
    exactly opposite order (every direction and NULL placement flipped), so one
    pass serves both ``ORDER BY v DESC`` and ``ORDER BY v``.

    One plan serves every size: rows are reduced to distinct (keys, order
    values) with their counts — a partially aggregated shuffle, so a value
    repeated in a third of the rows costs one row — ranked with
    ``ordered_prefix`` and joined back.
    """
    keys = list(keys)
    ocols = [c for c, _ in order]
    vc = df.groupBy(*keys, *ocols).agg(F.count(F.lit(1)).alias("__n"))
    ranked = ordered_prefix(vc, keys, order, ["__n"], buckets=buckets)
    before = F.col("__n_before")
    after = F.col("__n_total") - F.col("__n_through")
    denom = F.col("__n_total") - 1

    def pct(c):
        return F.when(F.col("__n_total") <= 1, F.lit(0.0)).otherwise(c / denom).cast("double")

    kinds = {
        "rank": (before + 1).cast("bigint"),
        "rank_reverse": (after + 1).cast("bigint"),
        "percent_rank": pct(before),
        "percent_rank_reverse": pct(after),
        "count": F.col("__n_total").cast("long"),
    }
    # Rename the join keys on the ranked side so the self-derived join is unambiguous.
    ranked = ranked.select(
        *[F.col(c).alias(f"__r_{c}") for c in keys + ocols],
        *[kinds[kind].alias(name) for name, kind in outputs.items()])
    cond = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in keys + ocols]
    out = df.join(ranked, cond, "inner")
    return out.select(*df.columns, *outputs)
