"""Gold layer: ML features, account/merchant summaries, risk score, daily metrics.

All inputs are the canonical transaction schema (``fjord.sources.tables.txn``).
Every function is lazy and returns a DataFrame; jobs decide where to write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.functions.exprs import safe_ratio
from fjord.operators.prefix import group_rank
from fjord.operators.sequence import sequential_features

def account_features(txn: DataFrame, heavy_threshold: int = 2_000_000, chunk_rows: int = 500_000) -> DataFrame:
    """Previous amount and 7-row rolling mean per account.

    Light accounts share one exchange + sort; accounts above
    ``heavy_threshold`` rows are split into ordered chunks with a halo
    (``fjord.operators.sequence``), so no account fills one task.
    """
    cols = ["tr_id", "tr_date", "tr_timestamp", "account_hash", "merchant_hash", "amount",
            "is_fraud", "transaction_type", "location"]
    return sequential_features(txn.select(*cols), "account_hash", ["tr_timestamp", "tr_id"], "amount",
                               heavy_threshold=heavy_threshold, chunk_rows=chunk_rows)


def ml_features(txn: DataFrame, rank_buckets: int | None = None) -> DataFrame:
    """Previous amount, 7-row rolling mean, daily rank / percent rank.

    The two account windows share one exchange + sort. The daily ranks do not
    use ``PARTITION BY tr_date`` — a day is a hot group by construction (every
    row of the day in one task) — but ``group_rank``'s bucketed prefix counts.
    """
    ranked = group_rank(account_features(txn), ["tr_date"], [("amount", True)],
                        {"daily_amount_rank": "rank_reverse",
                         "daily_amount_percent_rank": "percent_rank"},
                        buckets=rank_buckets)
    return ranked.select(
        "tr_id", "tr_date", "account_hash", "merchant_hash", "amount", "is_fraud",
        "transaction_type", "location", "prev_amount", "rolling_avg_amount_7",
        "daily_amount_rank", "daily_amount_percent_rank",
    )


def lead_amount(txn: DataFrame, heavy_threshold: int = 2_000_000, chunk_rows: int = 500_000) -> DataFrame:
    """Next amount per account (documented in the reference, built here)."""
    base = txn.select("tr_id", "account_hash", "tr_timestamp", "amount")
    return sequential_features(base, "account_hash", ["tr_timestamp", "tr_id"], "amount", lag_col=None,
                               roll_col=None, lead_col="next_amount",
                               heavy_threshold=heavy_threshold, chunk_rows=chunk_rows)


def user_summary(txn: DataFrame) -> DataFrame:
    """A2: per-account count, sum, mean and fraud count (partial + final aggregate)."""
    return txn.groupBy("account_hash").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.sum("is_fraud").cast("bigint").alias("fraud_count"),
    )


def merchant_summary(txn: DataFrame, amount_scale: int = 6, rank_buckets: int | None = None) -> DataFrame:
    """A3 + W5: per-merchant totals and a global fraud rank.

    ``sum(amount)`` is rounded before ranking: float addition order changes
    with partitioning and must not change ranks. The global rank runs through
    ``group_rank`` with no keys, so no single task sorts all merchants.
    """
    agg = txn.groupBy("merchant_hash").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.round(F.sum("amount"), amount_scale).alias("total_amount"),
        F.sum("is_fraud").cast("bigint").alias("fraud_count"),
    )
    return group_rank(agg, [], [("fraud_count", False), ("total_amount", False)],
                      {"fraud_rank": "rank"}, buckets=rank_buckets)


def user_risk_score(summary: DataFrame) -> DataFrame:
    """A4: fraud_count / nullif(transaction_count, 0) as double."""
    return summary.select(
        "account_hash",
        safe_ratio(F.col("fraud_count"), F.col("transaction_count")).alias("risk_score"),
    )


def daily_fraud_metrics(txn: DataFrame) -> DataFrame:
    """A10: the daily table the alerting stage reads (fraud amount per day)."""
    return txn.groupBy("tr_date").agg(
        F.coalesce(F.sum(F.when(F.col("is_fraud") == 1, F.col("amount"))), F.lit(0.0)).alias("fraud_amount"),
        F.sum("is_fraud").cast("bigint").alias("fraud_count"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def region_risk(txn: DataFrame) -> DataFrame:
    """Demo question 3: fraud rate by location, ranked (few locations → tiny window)."""
    agg = txn.groupBy("location").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("is_fraud").cast("bigint").alias("fraud_count"),
    ).withColumn("fraud_rate", F.round(safe_ratio(F.col("fraud_count"), F.col("transaction_count")), 6))
    return group_rank(agg, [], [("fraud_rate", False), ("fraud_count", False)], {"risk_rank": "rank"})


def rising_velocity(features: DataFrame) -> DataFrame:
    """Demo question 2: accounts whose latest amount is above their 7-row mean.

    The latest row per account is an arg-max aggregate (partial aggregation,
    no per-account sort), keyed by (tr_timestamp, tr_id).
    """
    latest = features.groupBy("account_hash").agg(
        F.max_by(F.struct("amount", "rolling_avg_amount_7", "tr_id"),
                 F.struct("tr_timestamp", "tr_id")).alias("last"))
    return latest.select(
        "account_hash",
        F.col("last.tr_id").alias("last_tr_id"),
        F.col("last.amount").alias("last_amount"),
        F.col("last.rolling_avg_amount_7").alias("rolling_avg_amount_7"),
    ).filter(F.col("last_amount") > F.col("rolling_avg_amount_7"))


def top_fraud_merchant(msummary: DataFrame) -> DataFrame:
    """Demo question 1: the merchant(s) ranked first by fraud."""
    return msummary.filter(F.col("fraud_rank") == 1)
