"""The public jobs from raw CSV to alert report, crash safety of versions and memory, catalog counts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fjord.config import Paths
from fjord.operators import clean, merge
from fjord.plans import jobs
from fjord.sources import keyed
from fjord.sources import schema as S
from fjord.sources.tables import raw_txn, txn
from fjord.streaming import bronze, silver
from tests.conftest import SF_SMALL


def test_jobs_chain(spark, tmp_path):
    paths = Paths(str(tmp_path / "lake"), "test")
    raw = raw_txn(spark, SF_SMALL)
    csv = str(tmp_path / "raw_csv")
    raw.coalesce(2).write.option("header", True).csv(csv)

    prof = jobs.profile(spark, csv, str(tmp_path / "profile"))
    assert prof.count() == len(raw.columns)
    assert jobs.load_profile(spark, str(tmp_path / "profile")).filter("is_pii").count() == 5
    with pytest.raises(FileNotFoundError):
        jobs.load_profile(spark, str(tmp_path / "missing"))
    config = str(tmp_path / "config")
    jobs.write_profile_config(spark, csv, config)

    jobs.run_landing(csv, paths, spark, profile_path=config)
    landed = spark.read.json(paths.landing)
    assert landed.count() == raw.count() + 2
    line = next(r[0] for r in spark.read.text(paths.landing).collect() if '"amount":null' in r[0])
    assert set(json.loads(line)) == set(jobs.LANDING_NAMES.values())  # a NULL is a field, not a gap

    jobs.run_bronze(spark, paths)
    b = bronze.read_bronze(spark, paths.bronze)
    assert b.count() == raw.count() + 2
    assert b.filter(F.col("_rescued_data").isNotNull()).count() >= 1  # the 'bad-amount' copy

    jobs.run_silver(spark, paths, as_of="2026-12-01")
    good = silver.read_silver(spark, paths.silver_good)
    # what landing made unparsable is NULL by now, so the rules see the coerced feed
    feed = raw.withColumn("TransactionAmount", F.col("TransactionAmount").try_cast("double")) \
        .withColumn("TransactionDate", F.col("TransactionDate").try_cast("timestamp"))
    assert good.count() == clean.silver_good(feed, as_of="2026-12-01").count() > 0
    # every digit survives (which row of a repeated key stays depends on the column order)
    assert {r[0] for r in good.select("TransactionAmount").collect()} <= {r[0] for r in feed.select("TransactionAmount").collect()}
    assert good.filter(F.date_format("TransactionTimestamp", "HH:mm:ss") != "00:00:00").count() > 0

    gold_input = jobs.run_gold(spark, paths)
    assert spark.read.parquet(paths.gold("ml_features")).count() == gold_input.count() == good.count()
    jobs.run_scd2(spark, paths, now="2024-02-01 00:00:00", mode="complete")
    jobs.run_scd2(spark, paths, now="2024-02-02 00:00:00", mode="complete")
    scd = jobs.read_scd2(spark, paths.gold("user_risk_scd2"))
    assert scd.filter(~F.col("is_current")).count() == 0
    assert scd.count() == spark.read.parquet(paths.gold("user_summary")).count()

    for _ in range(2):  # replace
        jobs.register_tables(spark, paths)
        for name, path in [("bronze_transactions", paths.bronze), ("silver_transactions", paths.silver_good),
                           ("silver_quarantine", paths.silver_quarantine), ("ml_features", paths.gold("ml_features")),
                           ("user_summary", paths.gold("user_summary")), ("merchant_summary", paths.gold("merchant_summary"))]:
            files = spark.read.option("mergeSchema", "true").parquet(path)
            table = spark.table(f"{paths.database}.{name}")
            assert table.count() == files.count() > 0, name
            assert sorted(table.columns) == sorted(files.columns), name
    assert spark.table(f"{paths.database}.user_risk_scd2").count() == scd.count()

    report = jobs.run_alerts(spark, paths).first()
    flagged = report["alerts"]
    assert len(flagged) == report["alert_count"] and all(r["fraud_amount"] > report["threshold"] for r in flagged)
    saved = spark.read.json(paths.gold("alerts")).first()
    assert saved["alert_count"] == report["alert_count"] and "executive_summary" in saved.asDict()


def test_documents_and_answers(spark, tmp_path):
    paths, gd = Paths(str(tmp_path / "lake"), "test"), str(tmp_path / "exports")
    users = spark.createDataFrame([("u1", 2, 5.123456789), ("u2", 1, None)], "account_hash string, n long, total double")
    users.write.parquet(f"{gd}/user_summary.parquet")
    users.write.option("header", True).csv(f"{gd}/merchant_summary.csv")
    with open(f"{gd}/daily_metrics.json", "w", encoding="utf-8") as fh:  # one JSON array document
        fh.write('[{"tr_date": "2024-01-02", "fraud_amount": 5.5}, {"tr_date": "2024-01-01", "fraud_amount": 1.0}]')
    with open(f"{gd}/notes.txt", "w", encoding="utf-8") as fh:  # another suffix: skipped
        fh.write("not a gold export")
    docs = jobs.gold_documents(spark, gd)
    listed = {r["id"]: r for r in docs.collect()}
    assert sorted(listed) == ["daily_metrics", "merchant_summary", "user_summary"]
    assert json.loads(listed["user_summary"]["text"]) == [{"account_hash": "u1", "n": 2, "total": 5.123456789},
                                                          {"account_hash": "u2", "n": 1, "total": None}]
    assert listed["daily_metrics"]["text"].startswith('[{"fraud_amount":1.0,"tr_date":"2024-01-01"}')
    store = str(tmp_path / "store")
    jobs.upsert_documents(spark, store, docs)
    jobs.upsert_documents(spark, store, docs)
    assert jobs.read_documents(spark, store).count() == 3
    qs = spark.createDataFrame([(1, "fraud_amount by tr_date"), (2, "nothing known")], "question_id int, question string")
    index = jobs.run_index(spark, store)
    answers = {r["question_id"]: r for r in jobs.run_answers(spark, paths, qs, store).collect()}
    assert jobs.run_index(spark, store) == index  # asked, not built again
    assert answers[1]["context_ids"].startswith("daily_metrics") and answers[2]["context_ids"] == ""


def test_index_follows_the_store(spark, tmp_path):
    paths, store = Paths(str(tmp_path / "lake"), "test"), str(tmp_path / "store")
    jobs.upsert_documents(spark, store, spark.createDataFrame([("a", "old words"), ("b", "other")], "id string, text string"))
    first = jobs.run_index(spark, store)
    os.remove(f"{first}/stats/_SUCCESS")  # the builder died
    second = jobs.run_index(spark, store)
    assert second != first and jobs.run_index(spark, store) == second
    jobs.upsert_documents(spark, store, spark.createDataFrame([("a", "new text")], "id string, text string"))
    qs = spark.createDataFrame([(1, "old"), (2, "text")], "question_id int, question string")
    answers = {r["question_id"]: r["context_ids"] for r in jobs.run_answers(spark, paths, qs, store).collect()}
    assert answers == {1: "", 2: "a"} and jobs.run_index(spark, store) not in (first, second)


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_runs_write_only_the_buckets_they_touch(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [(i, f"text {i}") for i in range(1000)] + [(None, "no id")]
    jobs.upsert_documents(spark, store, spark.createDataFrame(rows, "id long, text string"))
    before = _files(store)
    changed = spark.createDataFrame([(i, f"new {i}") for i in range(0, 1000, 100)] + [(5000, "added")], "id long, text string")
    version = jobs.upsert_documents(spark, store, changed)
    touched = {r[0] for r in changed.select(keyed.bucket_of("id", keyed.BUCKETS)).collect()}
    written = {os.path.basename(os.path.dirname(f)) for f in _files(f"{store}/{version}/current")}
    assert written == {f"{keyed.BUCKET}={b}" for b in touched} and before <= _files(store)
    want = dict(rows) | {i: f"new {i}" for i in range(0, 1000, 100)} | {5000: "added"}
    assert {r["id"]: r["text"] for r in jobs.read_documents(spark, store).collect()} == want
    state = keyed.state(spark, store)
    reading = keyed.read_current(spark, state, changed.schema, sorted(touched))
    assert len(reading.inputFiles()) < len(jobs.read_documents(spark, store).inputFiles()) / 3
    assert jobs.upsert_documents(spark, store, changed.limit(0)) == version  # nothing to do, nothing written
    keyed.compact(spark, store, changed.schema, "id")
    assert len(keyed.state(spark, store).runs) == 1
    assert {r["id"]: r["text"] for r in jobs.read_documents(spark, store).collect()} == want


@pytest.mark.parametrize("mode", ["single", "complete"])
def test_scd2_store_equals_the_whole_merge(spark, tmp_path, mode):
    """Run after run the bucketed store holds what merging the whole table gives; closed rows are written once."""
    root, whole = str(tmp_path / "risk"), spark.createDataFrame([], merge.SCD2_SCHEMA)
    steps = [{"a": .1, "b": .2, "n": None}, {"a": .1, "b": .5, "c": None, "n": None}, {"a": .1, "c": .3, None: .4}, {"a": .1, "c": .3, None: .4},
             {"a": .9, "b": .2, "n": .7}]
    closed = set()
    for i, step in enumerate(steps):
        source = spark.createDataFrame(list(step.items()), "account_hash string, risk_score double")
        at = f"2024-01-0{i + 1} 00:00:00"
        whole = spark.createDataFrame(merge.scd2_merge(whole, source, at, mode).collect(), merge.SCD2_SCHEMA)
        was = keyed.state(spark, root)
        version = keyed.scd2(spark, root, source, at, mode, buckets=4)
        assert sorted(map(str, jobs.read_scd2(spark, root).collect())) == sorted(map(str, whole.collect()))
        if mode == "complete" and i == 3:
            assert was.version == version  # nothing changed, nothing written
        now = {f for f in _files(root) if "/closed/" in f}
        assert closed <= now
        closed = now
    keyed.compact(spark, root, merge.SCD2_SCHEMA, "account_hash")
    assert sorted(map(str, jobs.read_scd2(spark, root).collect())) == sorted(map(str, whole.collect()))


def test_a_second_registration_adds_only_its_own(spark, tmp_path, monkeypatch):
    paths = Paths(str(tmp_path / "lake"), "again")
    raw = raw_txn(spark, SF_SMALL).withColumn("_ingestion_date", F.lit("2026-12-01").cast("date")) \
        .withColumn("_rescued_data", F.lit(None).cast("string"))
    silver.process_batch(raw, 0, paths.silver_good, paths.silver_quarantine)
    asked, sql = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: asked.append(text) or sql(text, *a, **k))
    jobs.register_tables(spark, paths)
    table = f"{paths.database}.silver_transactions"
    one = spark.table(table).count()
    assert one == silver.read_silver(spark, paths.silver_good).count() > 0
    late = raw.filter("TransactionDate like '2024-01-0%'").withColumn("Extra", F.lit("x"))
    silver.process_batch(late, 1, paths.silver_good, paths.silver_quarantine)
    silver.process_batch(raw.limit(0), 2, paths.silver_good, paths.silver_quarantine)  # no rows, no partitions
    asked.clear()
    jobs.register_tables(spark, paths)
    added = [t for t in asked if "ADD IF NOT EXISTS" in t and "silver_transactions" in t]
    assert len(added) == 1 and "`_batch_id` = '1'" in added[0] and "ADD COLUMNS" in " ".join(asked)
    assert not any(w in t for t in asked for w in ("DROP", "CREATE TABLE", "MSCK"))
    got, want = spark.table(table), silver.read_silver(spark, paths.silver_good)
    assert got.count() == want.count() > one and got.filter("Extra = 'x'").count() == want.filter("Extra = 'x'").count() > 0
    assert spark.table(f"{paths.database}.silver_quarantine").count() == silver.read_silver(spark, paths.silver_quarantine).count()
    # the SCD2 table follows its store
    root = paths.gold("user_risk_scd2")
    for i, step in enumerate([{"a": .1, "b": .2}, {"a": .1, "b": .5}, {"b": .5, "c": .1}]):
        keyed.scd2(spark, root, spark.createDataFrame(list(step.items()), "account_hash string, risk_score double"), f"2024-01-0{i + 1}", "single")
        asked.clear()
        jobs.register_tables(spark, paths)
        assert i == 0 or not any("CREATE TABLE" in t for t in asked)
        got = spark.table(f"{paths.database}.user_risk_scd2").drop("piece")
        assert sorted(map(str, got.collect())) == sorted(map(str, jobs.read_scd2(spark, root).collect()))


def test_versions_survive_a_crash(spark, tmp_path):
    store = str(tmp_path / "store")
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    first = jobs.upsert_documents(spark, store, docs)
    second = jobs.upsert_documents(spark, store, spark.createDataFrame([(1, "x"), (1, "y")], "id int, text string"))
    stored = lambda: sorted(map(tuple, jobs.read_documents(spark, store).collect()))
    assert stored() == [(1, "y"), (2, "b")]  # one row per id, whatever the order of the updates
    os.remove(f"{store}/{second}/commit/_SUCCESS")  # the writer died before its commit
    assert jobs.current_version(spark, store) == first and stored() == [(1, "a"), (2, "b")]
    third = jobs.upsert_documents(spark, store, spark.createDataFrame([(3, "c")], "id int, text string"))
    assert stored() == [(1, "a"), (2, "b"), (3, "c")]
    for v in (first, third):
        os.remove(f"{store}/{v}/commit/_SUCCESS")
    with pytest.raises(RuntimeError):
        jobs.current_version(spark, store)  # never taken for a first run
    assert jobs.current_version(spark, str(tmp_path / "none")) is None
    assert merge.upsert(docs, docs.limit(0), "id").count() == 2


def test_schema_memory_survives_a_crash(spark, tmp_path):
    path = str(tmp_path / "memory")
    a = spark.createDataFrame([(1, "x")], "a int, b string").schema
    b = spark.createDataFrame([(1.0, "x")], "c double, b string").schema
    S.evolve_schema(spark, path, a)
    S.evolve_schema(spark, path, b)
    assert S.load_schema(spark, path).names == ["a", "b", "c"]
    os.makedirs(f"{path}/_temporary/0/_temporary", exist_ok=True)  # a writer that died
    assert S.load_schema(spark, path).names == ["a", "b", "c"]
    for f in os.listdir(path):
        if f.startswith("part-"):
            open(f"{path}/{f}", "w").close()
    with pytest.raises(RuntimeError):
        S.load_schema(spark, path)


def test_train_and_evaluate_jobs(spark, tmp_path):
    paths = Paths(str(tmp_path / "lake"), "test")
    jobs.write_gold(spark, txn(spark, SF_SMALL), paths)
    report = jobs.run_train(spark, paths, max_iter=3).first()
    assert {"account_hash_freq", "merchant_hash_freq"} <= set(report["feature_columns"])
    results = jobs.run_evaluate(spark, paths)
    n = spark.read.parquet(paths.gold("ml_features")).count()
    assert sum(r["row_count"] for r in results["confusion_matrix"].collect()) == n
    assert spark.read.json(paths.gold("evaluation") + "/pr_curve").count() == results["pr_curve"].count() > 0
    assert spark.read.parquet(paths.gold("model_runs")).count() == 1
