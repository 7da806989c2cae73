"""Spark ML training on a planted label beats the base rate (M1–M7)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fjord.operators import features, gold, ml
from fjord.sources.tables import txn
from tests.conftest import SF_MID


def test_planted_label(spark, tmp_path):
    t = txn(spark, SF_MID)
    avg = F.avg("amount").over(Window.partitionBy("account_hash"))
    flip = (features.hash_unit(F.col("tr_id"), 7) % 100) < 5
    planted = t.withColumn("is_fraud", ((F.col("amount") > 3 * avg) != flip).cast("int"))
    feats = gold.ml_features(planted)
    numeric = ["amount", "prev_amount", "rolling_avg_amount_7", "daily_amount_percent_rank"]
    model, scored, report, tables = ml.train(feats, numeric, max_iter=15)
    r = report.first()
    assert r["feature_columns"][:2] == ["transaction_type", "location"] and "amount" in r["feature_columns"]
    base = scored.agg(F.avg("label")).first()[0]
    assert r["pr_auc"] > base + 0.2
    assert 0.0 <= r["best_threshold"] <= 1.0
    ml.save_bundle(model, report, str(tmp_path / "bundle"), tables)
    ml.log_run(report, str(tmp_path / "runs"), "test", len(numeric))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 1
    reloaded = ml.PipelineModel.load(str(tmp_path / "bundle/model"))
    assert ml.score(reloaded, ml.prepare(features.with_frequencies(feats.limit(5), tables), "is_fraud", numeric)).count() == 5
    res = ml.evaluate(reloaded, feats, r["best_threshold"], numeric, frequencies=tables)
    ml.save_evaluation(res, str(tmp_path / "eval"))
    cm = {(x["actual"], x["predicted"]): x["row_count"] for x in res["confusion_matrix"].collect()}
    assert sum(cm.values()) == feats.count()
    assert res["classification_report"].count() == 5


def test_stratified_split_ratio(spark):
    t = txn(spark, SF_MID)
    s = features.stratified_split(t.select("tr_id", "is_fraud"))
    counts = {(r["is_fraud"], r["split"]): r["count"] for r in s.groupBy("is_fraud", "split").count().collect()}
    for y in (0, 1):
        n = counts[(y, "test")] + counts[(y, "train")]
        assert counts[(y, "test")] == -(-n * 2 // 10)
