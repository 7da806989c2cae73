"""Landing: column mapping, coercing parse, day key, bad-record injection, JSONL sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fjord.functions.constants import BUSINESS_MAPPING
from fjord.functions.exprs import ident

DAY = "landing_partition"


def normalized_names(columns: list[str], business: Mapping[str, str] = BUSINESS_MAPPING) -> dict[str, str]:
    """P2 then P1: lower-case, spaces → ``_``, then the business names."""
    out = {}
    for c in columns:
        n = c.lower().replace(" ", "_")
        out[c] = business.get(n, n)
    return out


def rename_mapped(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """P1/P2 as one projection (no data movement)."""
    mapping = dict(mapping) if mapping is not None else normalized_names(df.columns)
    return df.select(*[F.col(ident(c)).alias(mapping.get(c, c)) for c in df.columns])


def coerce_parse(df: DataFrame) -> DataFrame:
    """P5: bad dates / numbers become NULL instead of failing, plus the day key (P10)."""
    ts = F.coalesce(F.try_to_timestamp(F.col("transaction_date"), F.lit("yyyy-MM-dd HH:mm:ss")),
                    F.try_to_timestamp(F.col("transaction_date"), F.lit("yyyy-MM-dd")))
    return (df.withColumn("transaction_date", ts)
              .withColumn("amount", F.col("amount").try_cast("double"))
              .withColumn(DAY, F.date_format("transaction_date", "yyyy-MM-dd")))


def inject_bad_records(df: DataFrame, order: list[str] | None = None, n: int = 2) -> DataFrame:
    """Copy the first ``n`` rows with amount NULL / 'bad-amount' and no date.

    The copies keep the landing day computed before injection. ``amount``
    becomes text (all its digits) so the unparsable value survives the union.
    """
    order = order or ["transaction_id", "transaction_date", "amount"]
    as_text = df.withColumn("amount", F.col("amount").cast("string"))
    head = as_text.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)  # top-n, not a sort
    rn = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_last() for c in order]))  # n rows
    broken = (head.withColumn("__i", rn)
                  .withColumn("amount", F.when(F.col("__i") == 1, F.lit(None).cast("string"))
                              .otherwise(F.lit("bad-amount")))
                  .withColumn("transaction_date", F.lit(None).cast("timestamp"))
                  .drop("__i"))
    return as_text.unionByName(broken)


def landing_day_counts(df: DataFrame) -> DataFrame:
    """A5: rows per landing day, NULL day kept as ``unknown-date``."""
    return (df.groupBy(F.coalesce(F.col(DAY), F.lit("unknown-date")).alias(DAY))
              .agg(F.count(F.lit(1)).alias("row_count")))


def landing_payload(df: DataFrame) -> DataFrame:
    """K6 payload: ISO dates, day key as its own column (left out of the payload)."""
    return df.select(
        F.coalesce(F.col(DAY), F.lit("unknown-date")).alias(DAY),
        *[F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(c) if c == "transaction_date"
          else F.col(ident(c)) for c in df.columns if c != DAY])


def write_landing(df: DataFrame, path: str, max_records_per_file: int = 1_000_000) -> None:
    """K6 sink: one directory per day, immutable uniquely named JSON files.

    Spark names each part file with a per-write UUID, so ``append`` never
    overwrites an earlier landing. Rows are rebalanced by day: few files per
    day, and a hot day is split over several tasks.
    """
    out = landing_payload(df)
    (out.hint("rebalance", DAY).write.mode("append").partitionBy(DAY)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("ignoreNullFields", False)  # a missing value lands as null, not as a missing field
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS")
        .json(path))
