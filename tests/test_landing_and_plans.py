"""Landing sink round trip, cleaning rules, and physical-plan checks (pushdown, pruning, no hot task)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from fjord.operators import clean, landing
from fjord.sources.tables import raw_txn, txn
from fjord.operators import gold
from tests.conftest import SF_SMALL


def _landed(spark):
    return landing.inject_bad_records(landing.coerce_parse(landing.rename_mapped(raw_txn(spark, SF_SMALL))))


def test_landing_round_trip(spark, tmp_path):
    df = _landed(spark)
    out = str(tmp_path / "landing")
    landing.write_landing(df, out)
    landing.write_landing(df, out)  # append again: new unique files, nothing overwritten
    back = spark.read.json(out)
    assert back.count() == 2 * df.count()
    days = {r[0] for r in back.select("landing_partition").distinct().collect()}
    assert "unknown-date" in days
    # the payload never repeats the partition key, and dates are ISO
    one = spark.read.text(out + "/landing_partition=2024-01-01").first()[0]
    assert "landing_partition" not in one and "T" in one


def test_rules_are_ansi_safe(spark):
    assert clean.ansi_safe("CAST(x AS INT) < 0 AND try_cast(y AS INT) > 1") == \
        "TRY_CAST(x AS INT) < 0 AND try_cast(y AS INT) > 1"
    # a bad value under a CAST rule does not raise under ANSI
    df = spark.createDataFrame([("abc", "1"), ("-3", "x")], "TransactionAmount string, LoginAttempts string")
    assert clean.quarantine_by_rules(df, ["CAST(TransactionAmount AS DOUBLE) < 0"]).count() == 1


def test_reconcile_counts_match_fixture(spark):
    r = clean.reconcile(raw_txn(spark, "/root/testdata/sf0.01"), as_of="2026-12-01").first()
    assert (r["good_only"], r["bad_only"], r["both"], r["neither"]) == (9454, 93, 141, 447)
    assert r["good_after_dedup"] == 9409 and r["quarantined"] == 234


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushdown_and_pruning(spark):
    df = E.queries()["scan_parquet"](spark, SF_SMALL)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_partial_aggregation(spark):
    plan = _plan(gold.user_summary(txn(spark, SF_SMALL)))
    assert "partial_sum" in plan and "partial_count" in plan
