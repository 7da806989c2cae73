"""Gold as path-addressed SQL equals the DataFrame operators; profile override; stream from a table."""

from pyspark.sql import functions as F

from fjord.operators import clean, gold, quality
from fjord.sources.tables import raw_txn, txn
from fjord.streaming import silver
from tests.conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in cols) for r in df.collect())


def test_operators_over_a_path_addressed_scan(spark, tmp_path):
    path = str(tmp_path / "txn")
    txn(spark, SF_SMALL).write.parquet(path)
    by_path = spark.sql(f"SELECT * FROM parquet.`{path}`")  # S10
    cols = ["account_hash", "transaction_count", "total_amount"]
    assert _rows(gold.user_summary(by_path), cols) == _rows(gold.user_summary(txn(spark, SF_SMALL)), cols)


def test_override_profile(spark):
    base = quality.column_profile(raw_txn(spark, SF_SMALL))
    cand = spark.createDataFrame([("TransactionAmount", "decimal", ""), ("AccountID", "", "acct")],
                                 "column_name string, schema_hint string, mapped_name string")
    out = {r["column_name"]: r for r in quality.override_profile(base, cand).collect()}
    assert out["TransactionAmount"]["schema_hint"] == "decimal"
    assert out["TransactionAmount"]["mapped_name"] == "transactionamount"  # empty candidate keeps base
    assert out["AccountID"]["schema_hint"] == "string" and out["AccountID"]["mapped_name"] == "acct"
    assert len(out) == 16


def test_silver_from_registered_table(spark, tmp_path):
    raw = raw_txn(spark, SF_SMALL).withColumn("_ingestion_date", F.lit("2026-12-01").cast("date"))
    raw.write.saveAsTable("bronze_tbl", path=str(tmp_path / "bronze_tbl"))
    good, bad = str(tmp_path / "g"), str(tmp_path / "b")
    silver.run_silver(spark, "table:bronze_tbl", good, bad, str(tmp_path / "ck"))
    assert silver.read_silver(spark, good).count() == clean.silver_good(raw, as_of="2026-12-01").count()
    spark.sql("DROP TABLE bronze_tbl")


def test_derived_candidate_overrides_only_non_empty_fields(spark):
    df = spark.createDataFrame(
        [("1", "2.5", "2024-01-01 10:00:00", "x", None, "9876543210", "1" * 30), ("-7", "1e3", "2024-01-02", "y", None, "1", "2"),
         (None, "bad", "2024-01-03 00:00:00", "3", None, None, None)],
        "TransactionID string, Score string, TransactionDate string, Note string, Empty string, Big string, Huge string")
    base, candidate = quality.profile_with_candidate(df)
    cand = {r["column_name"]: (r["mapped_name"], r["schema_hint"]) for r in candidate.collect()}
    assert cand == {"TransactionID": ("transaction_id", "integer"), "Score": ("", ""),
                    "TransactionDate": ("transaction_date", "timestamp"), "Note": ("", ""), "Empty": ("", ""),
                    "Big": ("", "bigint"), "Huge": ("", "")}
    merged = {r["column_name"]: (r["mapped_name"], r["schema_hint"]) for r in quality.override_profile(base, candidate).collect()}
    # empty candidate fields keep the deterministic profile (lower-cased name, fixed hint or string)
    assert merged["Score"] == ("score", "string") and merged["Note"] == ("note", "string")
    assert merged["TransactionID"] == ("transaction_id", "integer")
    assert merged["TransactionDate"] == ("transaction_date", "timestamp")


def test_profile_config_record_round_trip(spark, tmp_path):
    from fjord.functions.constants import QUARANTINE_RULES
    from fjord.plans import jobs

    raw = raw_txn(spark, SF_SMALL)
    csv = str(tmp_path / "raw_csv")
    raw.coalesce(2).write.option("header", True).csv(csv)
    jobs.write_profile_config(spark, csv, str(tmp_path / "config"), environment="dev")
    rec = jobs.load_profile(spark, str(tmp_path / "config")).collect()
    assert len(rec) == 1
    r = rec[0]
    assert r["record_count"] == raw.count() and r["column_count"] == 16 and r["columns"] == raw.columns
    assert r["mapped_columns"]["IP Address"] == "ip_address" and r["schema_hints"]["CustomerAge"] == "integer"
    assert r["schema_hints"]["Channel"] == "string"
    assert r["pii_columns"] == ["AccountID", "Location", "DeviceID", "IP Address", "MerchantID"]
    assert r["quarantine_rules"] == QUARANTINE_RULES
    assert (r["generated_by"], r["environment"], r["dataset_path"]) == ("deterministic_fallback", "dev", csv)
