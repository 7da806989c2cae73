"""Model feature preparation (M1, M2, P18) as column expressions and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjord.functions.exprs import ident
from fjord.operators.prefix import bucket_count

LABEL = "is_fraud"
DROPPED = ["is_fraud", "tr_id", "tr_date"]  # label, id and date never enter the features
CATEGORICAL = ["transaction_type", "location"]
NUMERIC = ["amount", "prev_amount", "rolling_avg_amount_7", "daily_amount_rank", "daily_amount_percent_rank"]


def dummy_name(column: str, value: str | None) -> str:
    """One-hot column name ``<column>_<value>``; the missing value is ``<column>_nan``."""
    return f"{column}_{'nan' if value is None else value}"


def one_hot_counts(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """M1 summary: per categorical column, each category's dummy name, index and count.

    Index order is frequency-descending, ties by value (the StringIndexer
    rule); the NULL category (``_nan``) is always listed, last, as the
    reference adds one for every column. Works on category counts only, so
    the ranking window sees (#categories) rows, not the table.
    """
    parts = []
    for c in columns:
        counts = df.groupBy(F.col(ident(c)).cast("string").alias("category")).agg(
            F.count(F.lit(1)).alias("row_count"))
        parts.append(counts.select(F.lit(c).alias("source_column"), "category", "row_count"))
    allc = parts[0]
    for p in parts[1:]:
        allc = allc.unionByName(p)
    seen = allc.filter(F.col("category").isNotNull())
    w = Window.partitionBy("source_column").orderBy(F.col("row_count").desc(), F.col("category"))
    indexed = seen.withColumn("category_index", F.row_number().over(w) - 1)
    # the NULL category: count of NULLs (0 when none) and the index after the last category
    nulls = allc.groupBy("source_column").agg(
        F.coalesce(F.sum(F.when(F.col("category").isNull(), F.col("row_count"))), F.lit(0)).alias("row_count"),
        F.count_if(F.col("category").isNotNull()).alias("category_index"),
    ).select("source_column", F.lit(None).cast("string").alias("category"), "row_count", "category_index")
    out = indexed.unionByName(nulls)
    return out.withColumn(
        "feature", F.concat_ws("_", "source_column", F.coalesce(F.col("category"), F.lit("nan")))) \
        .withColumn("category_index", F.col("category_index").cast("int"))


def dummy_expr(df_columns: Sequence[str], feature: str) -> Column:
    """Value of one training feature; a feature the frame lacks is 0."""
    if feature in df_columns:
        return F.coalesce(F.col(ident(feature)).cast("double"), F.lit(0.0))
    for c in CATEGORICAL:
        if feature.startswith(c + "_") and c in df_columns:
            value = feature[len(c) + 1:]
            if value == "nan":
                return F.col(ident(c)).isNull().cast("double")
            return F.coalesce((F.col(ident(c)) == F.lit(value)).cast("double"), F.lit(0.0))
    return F.lit(0.0)


def align_features(df: DataFrame, feature_columns: Sequence[str], keep: Sequence[str] = ("tr_id",)) -> DataFrame:
    """Exactly the training columns in training order; missing → 0, extra dropped."""
    return df.select(*[F.col(ident(k)) for k in keep],
                     *[dummy_expr(df.columns, f).alias(f) for f in feature_columns])


HASHED = ["account_hash", "merchant_hash"]


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """M1: (value, share of the rows) of a hash column; one partially aggregated count, a scalar for the total."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(F.col(ident(column)).alias("value")).agg((F.count(F.lit(1)) / total).alias("share"))


def with_frequencies(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``df`` with ``<column>_freq`` for every table; a value the table lacks has frequency 0, NULL is a value."""
    out = df
    for c, t in tables.items():
        t = t.select(F.col("value").alias("__v"), F.col("share").alias("__s"))
        out = (out.join(t, F.col(ident(c)).eqNullSafe(F.col("__v")), "left")
                  .withColumn(f"{c}_freq", F.coalesce("__s", F.lit(0.0))).drop("__v", "__s"))
    return out


def hash_unit(key: Column, seed: int = 42) -> Column:
    """Deterministic 48-bit pseudo-random integer per key (SHA-256 prefix)."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 12),
                  16, 10).cast("bigint")


def stratified_split(df: DataFrame, label: str = LABEL, key: str = "tr_id", test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """M2: exact per-class split — the first ceil(test_size·n_c) rows of each class by hash order.

    A class is a hot group by definition (the negative class can be most of the
    table), so no class is sorted. The hash is uniform, so equal ranges of it
    hold like numbers of rows: one count per class and range finds the range in
    which a class's cut falls, rows of other ranges are decided where they stand,
    and only that range's rows are ranked.
    """
    ranges = 4 * bucket_count(df)
    u = F.col("__u")
    place = F.coalesce(F.floor(u * F.lit(ranges) / F.lit(1 << 48)) + 1, F.lit(0))  # a row without a key comes first
    h = df.withColumn("__u", hash_unit(F.col(key), seed)).withColumn("__range", place)
    counts = h.groupBy(label, "__range").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(label)  # classes x ranges rows
    counts = counts.select(F.col(label).alias("__label"), F.col("__range").alias("__cut"), "n",
                           F.sum("n").over(w.orderBy("__range")).alias("through"), F.sum("n").over(w).alias("all"))
    wanted = F.ceil(F.col("all") * F.lit(str(test_size)).cast("decimal(10,6)"))
    before = F.col("through") - F.col("n")
    cuts = counts.filter((before < wanted) & (wanted <= F.col("through"))).select(
        "__label", "__cut", (wanted - before).alias("__take"))  # one row per class
    tagged = h.join(cuts, F.col(label).eqNullSafe(F.col("__label")), "left")
    sure = tagged.filter(~F.col("__range").eqNullSafe(F.col("__cut"))).withColumn(
        "split", F.when(F.col("__range") < F.col("__cut"), F.lit("test")).otherwise(F.lit("train")))
    order = Window.partitionBy("__label").orderBy(u.asc_nulls_first(), F.col(key).asc_nulls_first())
    close = tagged.filter(F.col("__range").eqNullSafe(F.col("__cut"))).withColumn(
        "split", F.when(F.rank().over(order) <= F.col("__take"), F.lit("test")).otherwise(F.lit("train")))
    return sure.unionByName(close).select(*df.columns, "split")
