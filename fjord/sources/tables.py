"""Scans of the driver tables and the two derived transaction views.

``txn`` is the canonical gold-input schema (tr_id, tr_date, tr_timestamp,
account_hash, merchant_hash, amount, is_fraud, transaction_type, location)
projected from ``events``. ``raw_txn`` is the raw 16-column string feed with a
deterministic corruption per ``event_id`` so the cleaning paths have work to do.
Both are plain projections: Catalyst prunes the parquet scan to the columns a
query actually uses and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjord.functions.exprs import money_text, pii_hash

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table.

    A table that is one split (a single small file) is dealt out to all cores
    for the CPU-heavy first stage; that moves less than one split's bytes.
    Every larger table is left as scanned, whatever the cluster's size.
    Column pruning and filters still reach the scan: Catalyst pushes both
    through a repartition.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() == 1:  # planning only, no job
        df = df.repartition(cores)
    return df


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical transaction view over ``events``."""
    return txn_from_events(table(spark, sf_dir, "events"))


def txn_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("tr_id"),
        F.to_date("ts").alias("tr_date"),
        F.col("ts").alias("tr_timestamp"),
        pii_hash(F.col("user_id").cast("string")).alias("account_hash"),
        pii_hash(F.get_json_object("props", "$.k")).alias("merchant_hash"),
        F.col("value").alias("amount"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
        F.col("event_type").alias("transaction_type"),
        F.concat(F.lit("LOC_"), (F.col("user_id") % 25).cast("string")).alias("location"),
    )


def corruption_kind(event_id: Column) -> Column:
    """First matching rule wins; see FIXTURES.md §3."""
    return (
        F.when(event_id % 71 == 0, "null_id")
        .when(event_id % 73 == 0, "duplicate")
        .when(event_id % 79 == 0, "negative_amount")
        .when(event_id % 83 == 0, "future_date")
        .when(event_id % 89 == 0, "bad_date")
        .when(event_id % 97 == 0, "bad_amount")
        .when(event_id % 101 == 0, "null_amount")
        .otherwise("none")
    )


RAW_COLUMNS = [
    "TransactionID", "AccountID", "TransactionAmount", "TransactionDate",
    "TransactionType", "Location", "DeviceID", "IP Address", "MerchantID",
    "Channel", "CustomerAge", "CustomerOccupation", "TransactionDuration",
    "LoginAttempts", "AccountBalance", "PreviousTransactionDate",
]


def raw_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_txn_from_events(table(spark, sf_dir, "events"))


def raw_txn_from_events(events: DataFrame) -> DataFrame:
    """The raw all-string transaction feed (FIXTURES.md 1a) with planted faults."""
    eid, uid = F.col("event_id"), F.col("user_id")
    kind = corruption_kind(eid)
    ts_text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    # three decimals: amounts below a cent must survive every stage
    amount_text = F.when(F.col("value") > 0, F.concat(money_text(F.col("value")), (eid % 10).cast("string"))) \
        .otherwise(money_text(F.col("value")))
    base = events.select(
        kind.alias("_kind"),
        F.when(kind == "null_id", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("TX"), eid.cast("string"))).alias("TransactionID"),
        F.concat(F.lit("AC"), uid.cast("string")).alias("AccountID"),
        F.when(kind == "negative_amount", F.lit("-5.0"))
        .when(kind == "bad_amount", F.lit("bad-amount"))
        .when(kind == "null_amount", F.lit(None).cast("string"))
        .otherwise(amount_text).alias("TransactionAmount"),
        F.when(kind == "future_date", F.lit("2999-01-01"))
        .when(kind == "bad_date", F.lit("unknown"))
        .otherwise(ts_text).alias("TransactionDate"),
        F.col("event_type").alias("TransactionType"),
        F.concat(F.lit("LOC_"), (uid % 25).cast("string")).alias("Location"),
        F.concat(F.lit("D"), (uid % 40).cast("string")).alias("DeviceID"),
        F.concat_ws(".", F.lit("10"), F.lit("0"), (uid % 256).cast("string"),
                    (eid % 256).cast("string")).alias("IP Address"),
        F.concat(F.lit("M"), F.get_json_object("props", "$.k")).alias("MerchantID"),
        F.when(eid % 3 == 0, "Online").when(eid % 3 == 1, "ATM").otherwise("Branch").alias("Channel"),
        (18 + uid % 60).cast("string").alias("CustomerAge"),
        F.when(uid % 4 == 0, "Doctor").when(uid % 4 == 1, "Engineer")
        .when(uid % 4 == 2, "Student").otherwise("Retired").alias("CustomerOccupation"),
        (10 + eid % 290).cast("string").alias("TransactionDuration"),
        (1 + eid % 5).cast("string").alias("LoginAttempts"),
        money_text(F.col("value") * 37).alias("AccountBalance"),
        F.date_format(F.col("ts") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss").alias("PreviousTransactionDate"),
    )
    copies = F.when(F.col("_kind") == "duplicate", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.withColumn("_copy", F.explode(copies)).drop("_kind", "_copy")
