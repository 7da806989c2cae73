"""One runnable job per stage; the only place that reads and writes storage.

    landing → bronze → silver → gold → (train, evaluate, documents, alerts)

Every job takes a ``Paths`` object (one environment, one root) so the
stages agree on locations (SURVEY D10). Gold snapshots are idempotent
overwrites; the SCD2 table and the document store are bucketed by key, and a
run writes the buckets it touches into a folder of its own
(``fjord.sources.keyed``) — nothing that is read is overwritten.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fjord.config import Paths
from fjord.functions.constants import BUSINESS_MAPPING, SCHEMA_HINTS
from fjord.functions.exprs import ident, pii_hash
from fjord.operators import gold, landing, merge, ml, quality, retrieve, textindex
from fjord.operators.features import CATEGORICAL, HASHED, NUMERIC
from fjord.sources import inference, keyed
from fjord.sources.keyed import read_scd2  # noqa: F401  (part of this module's interface)
from fjord.streaming import bronze, silver


# One contract of names: landing writes business names, silver and gold use the raw feed's.
LANDING_NAMES = landing.normalized_names(list(SCHEMA_HINTS))  # raw name -> landed name
RAW_NAMES = {v: k for k, v in LANDING_NAMES.items()}
LANDING_HINTS = {LANDING_NAMES[c]: t for c, t in SCHEMA_HINTS.items()}


# ------------------------------------------------------------------ landing
def run_landing(raw_csv_or_df, paths: Paths, spark: SparkSession | None = None, profile_path: str | None = None) -> None:
    """K6 + S1/S2: raw CSV (or DataFrame) → daily JSONL files with two injected bad rows.

    With ``profile_path`` the saved profile (S12) supplies the column mapping;
    a business name it leaves out is filled in, as the stage needs them.
    """
    df = raw_csv_or_df
    if isinstance(raw_csv_or_df, str):
        df = spark.read.option("header", True).option("inferSchema", False).csv(raw_csv_or_df)
    mapping = None
    if profile_path is not None:
        saved = load_profile(spark or df.sparkSession, profile_path).select("mapped_columns").first()[0].asDict()
        mapping = {c: BUSINESS_MAPPING.get(saved.get(c) or "", saved.get(c)) or c for c in df.columns}
    landed = landing.inject_bad_records(landing.coerce_parse(landing.rename_mapped(df, mapping)))
    landing.write_landing(landed, paths.landing)


def profile(spark: SparkSession, raw_csv: str, out_path: str) -> DataFrame:
    """A7 + K7 + S1: all-string scan, column profile, one JSON report."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(raw_csv)
    prof = quality.column_profile(df)
    prof.coalesce(1).write.mode("overwrite").json(out_path)
    return prof


def write_profile_config(spark: SparkSession, raw_csv: str, out_path: str, environment: str = "test") -> DataFrame:
    """A7 + K7: the profile as one config record (one JSON document), as the landing stage reads it."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(raw_csv)
    record = quality.profile_record(quality.column_profile(df), raw_csv, environment)
    record.coalesce(1).write.mode("overwrite").json(out_path)
    return record


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    """A saved profile; a missing one is a clear error, not an empty frame."""
    try:
        return spark.read.json(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"Missing profile at {path}; run the profiler first") from exc


# ------------------------------------------------------------------ bronze / silver
def run_bronze(spark: SparkSession, paths: Paths, hints=None, fmt: str = "json",
               max_files_per_trigger: int | None = 10_000):
    """The landing folder into bronze — JSONL (the landing stage's output) or a CSV feed.

    Hints default to the names the feed has: the landed ones in JSONL, the raw
    ones in CSV. A CSV feed is bound file by file by its own header
    (``bronze.run_bronze_csv``). A batch takes at most ``max_files_per_trigger`` files.
    """
    ckpt = paths.checkpoint("bronze_stream")
    if fmt == "csv":
        out = bronze.run_bronze_csv(spark, paths.landing, paths.bronze, ckpt, hints or SCHEMA_HINTS,
                                    paths.environment, max_files_per_trigger, memory=paths.schema_memory)
    elif fmt == "json":
        out = bronze.run_bronze(spark, paths.landing, paths.bronze, paths.schema_memory, ckpt, hints or LANDING_HINTS,
                                paths.environment, max_files_per_trigger=max_files_per_trigger)
    else:
        raise ValueError(f"unknown landing format {fmt!r}")
    register_tables(spark, paths, only=["bronze_transactions"])  # readers see the new rows at once
    return out


def run_silver(spark: SparkSession, paths: Paths, as_of=None, strict: bool = False,
               max_files_per_trigger: int | None = 10_000, across_batches: bool = False):
    """Bronze into silver's two tables, under the raw feed's names (landed names are turned back).

    ``across_batches`` drops rows whose business key an earlier batch has stored (D6).
    """
    return silver.run_silver(spark, paths.bronze, paths.silver_good, paths.silver_quarantine,
                             paths.checkpoint("silver_stream"), as_of=as_of, strict=strict, names=RAW_NAMES,
                             max_files_per_trigger=max_files_per_trigger, across_batches=across_batches)


# ------------------------------------------------------------------ gold
def silver_to_txn(silver_df: DataFrame, salt: str | None = None, fraud_col: str = "IsFraud") -> DataFrame:
    """The explicit silver → gold projection the reference leaves implicit.

    Silver's ``TransactionDate`` is the day; the time of day comes from
    ``TransactionTimestamp``, which ``silver.process_batch`` carries along.
    Without that column ``tr_timestamp`` is midnight and ``tr_id`` breaks ties.
    """
    time = "TransactionTimestamp" if "TransactionTimestamp" in silver_df.columns else "TransactionDate"
    fraud = (F.coalesce(F.col(fraud_col).cast("int"), F.lit(0)) if fraud_col in silver_df.columns
             else F.lit(0))
    return silver_df.select(
        F.col("TransactionID").alias("tr_id"),
        F.col("TransactionDate").cast("date").alias("tr_date"),
        F.col(time).cast("timestamp").alias("tr_timestamp"),
        pii_hash(F.col("AccountID"), salt).alias("account_hash"),
        pii_hash(F.col("MerchantID"), salt).alias("merchant_hash"),
        F.col("TransactionAmount").cast("double").alias("amount"),
        fraud.alias("is_fraud"),
        F.col("TransactionType").alias("transaction_type"),
        F.col("Location").alias("location"),
    )


def write_gold(spark: SparkSession, txn: DataFrame, paths: Paths) -> None:
    """K5: idempotent overwrite snapshots; every build reads only the columns it needs."""
    gold.ml_features(txn).write.mode("overwrite").parquet(paths.gold("ml_features"))
    gold.user_summary(txn).write.mode("overwrite").parquet(paths.gold("user_summary"))
    gold.merchant_summary(txn).write.mode("overwrite").parquet(paths.gold("merchant_summary"))
    gold.daily_fraud_metrics(txn).write.mode("overwrite").parquet(paths.gold("daily_metrics"))


def run_gold(spark: SparkSession, paths: Paths, salt: str | None = None) -> DataFrame:
    """Silver into the gold tables; returns the transactions they were built from."""
    txn = silver_to_txn(silver.read_silver(spark, paths.silver_good), salt)
    write_gold(spark, txn, paths)
    return txn


def run_scd2(spark: SparkSession, paths: Paths, now=None, mode: str = "single") -> str:
    """Merge the latest user risk into the SCD2 table; only the buckets of changed accounts are rewritten."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    source = gold.user_risk_score(spark.read.parquet(paths.gold("user_summary")))
    return keyed.scd2(spark, paths.gold("user_risk_scd2"), source, now, mode)


def upsert_documents(spark: SparkSession, store: str, new_docs: DataFrame, key: str = "id") -> str:
    """K9: keyed upsert into a Parquet document store; only the buckets of the given documents are rewritten."""
    return keyed.upsert(spark, store, new_docs, key)


def current_version(spark: SparkSession, table_root: str) -> str | None:
    """The newest complete run of a SCD2 table or document store; None without any, damage raises."""
    now = keyed.state(spark, table_root)
    return now.version if now else None


def read_documents(spark: SparkSession, store: str) -> DataFrame:
    """The current documents of a store."""
    now = keyed.state(spark, store)
    if now is None:
        raise FileNotFoundError(f"no document store at {store}")
    schema = next(iter(spark.read.parquet(p).schema for p in now.live.values()), None)
    return spark.createDataFrame([], "id string, text string, source string") if schema is None \
        else keyed.read_current(spark, now, schema)


def run_index(spark: SparkSession, store: str, key: str = "id") -> str:
    """R2: the text index of the store's current documents; an index that is still theirs is kept."""
    version, root = keyed.state(spark, store).version, f"{store.rstrip('/')}_index"
    have = [v for v in keyed.list_names(spark, root) if keyed.exists(spark, f"{root}/{v}/stats/_SUCCESS")] \
        if keyed.exists(spark, root) else []
    if have and textindex.is_of(spark, f"{root}/{have[-1]}", version):
        return f"{root}/{have[-1]}"
    return textindex.build(read_documents(spark, store), f"{root}/{keyed.new_version()}", key, source=version)


def _is_dir(spark: SparkSession, path: str) -> bool:
    p, fs = keyed.file_system(spark, path)
    return fs.getFileStatus(p).isDirectory()


def gold_documents(spark: SparkSession, gold_dir: str, names: list[str] | None = None) -> DataFrame | None:
    """R1 + S11: one document per gold export (parquet / csv / json by suffix), sorted by name.

    With no ``names`` the folder is listed; entries with another suffix are
    skipped. A single ``.json`` file is one JSON array of records; a ``.json``
    folder (Spark's output) is JSON lines. Each document is the export's first
    50 rows (``rows_document``), its source the export's path.
    """
    readers = {
        ".parquet": lambda path: spark.read.parquet(path),
        ".csv": lambda path: spark.read.option("header", True).option("inferSchema", True).csv(path),
        ".json": lambda path: (spark.read.json(path) if _is_dir(spark, path)
                               else spark.read.option("multiLine", True).json(path)),
    }
    parts = []
    for name in sorted(names if names is not None else keyed.list_names(spark, gold_dir)):
        stem, dot, suffix = name.rpartition(".")
        if not dot or f".{suffix}" not in readers:
            continue
        path = f"{gold_dir}/{name}"
        df = readers[f".{suffix}"](path)
        parts.append(retrieve.rows_document(df, stem, df.columns[:1]).withColumn("source", F.lit(path)))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


BATCH_PROPERTY = "fjord.last_batch"


def register_tables(spark: SparkSession, paths: Paths, only: list[str] | None = None) -> None:
    """K8: database + external Parquet tables over the layer paths.

    A table is created once and from then on only added to: the partitions of
    batches that came since the last run (its number is a table property; the
    last one is looked at again, as it may have been replayed), and columns
    these brought. So a run costs what is new, and readers never miss a table.
    The SCD2 table has a partition per bucket, whose location moves when the
    bucket is rewritten, and one per run for closed rows.
    """
    db = paths.database
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    places = {"bronze_transactions": paths.bronze, "silver_transactions": paths.silver_good,
              "silver_quarantine": paths.silver_quarantine,
              **{name: paths.gold(name) for name in ("ml_features", "user_summary", "merchant_summary", "daily_metrics")}}
    for name, place in places.items():
        if (only is None or name in only) and keyed.exists(spark, place):
            _register(spark, f"{db}.{name}", place)
    if only is None or "bronze_transactions" in only:
        _register_typed(spark, f"{db}.bronze_transactions", paths)
    risk = keyed.state(spark, paths.gold("user_risk_scd2")) if only is None or "user_risk_scd2" in only else None
    if risk is not None:
        _register_scd2(spark, f"{db}.user_risk_scd2", risk)


def _register(spark: SparkSession, table: str, place: str) -> None:
    """A table over one folder, with the ``key=value`` folders of new batches as partitions."""
    batches = sorted((int(n.split("=", 1)[1]), n) for n in keyed.list_dirs(spark, place) if n.rpartition("=")[2].isdigit())
    new, known = batches, spark.catalog.tableExists(table)
    if known and batches:
        done = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == BATCH_PROPERTY).first()
        new = [b for b in batches if done is None or b[0] >= int(done["value"])]
    partitions = [p for _, n in new for p in _partitions(spark, f"{place}/{n}", [n])]
    if batches and not partitions:
        return  # no new rows
    if partitions:
        folders = sorted({f"{place}/{p[0]}" for p in partitions})
        found = spark.read.option("mergeSchema", "true").option("basePath", place).parquet(*folders).schema
    else:
        found = spark.read.parquet(place).schema
    keys = list(dict.fromkeys(k.split("=", 1)[0] for p in partitions for k in p))
    columns = lambda fields: ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in fields)
    if not known:
        by = f" PARTITIONED BY ({', '.join(map(ident, keys))})" if keys else ""
        spark.sql(f"CREATE TABLE {table} ({columns(found.fields)}) USING PARQUET{by} LOCATION '{place}'")
    else:
        have = {c.lower() for c in spark.table(table).columns}
        fresh = [f for f in found.fields if f.name.lower() not in have]
        if fresh:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns(fresh)})")
    for at in range(0, len(partitions), 500):
        specs = " ".join(f"PARTITION ({_spec(p)}) LOCATION '{place}/{'/'.join(p)}'" for p in partitions[at:at + 500])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    if batches:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BATCH_PROPERTY}' = '{batches[-1][0]}')")
    spark.catalog.refreshTable(table)


def _register_typed(spark: SparkSession, table: str, paths: Paths) -> None:
    """``<table>_typed``: a view of a bronze table under the types remembered for its unhinted columns."""
    if spark.catalog.tableExists(table):
        sets = inference.load_sets(spark, f"{paths.schema_memory}/types")
        columns = ", ".join(
            f"CAST({ident(f.name)} AS {t}) AS {ident(f.name)}" if f.dataType == T.StringType() and f.name in sets
            and (t := inference.narrowest(sets[f.name])) not in ("string", "void") else ident(f.name)
            for f in spark.table(table).schema.fields)
        spark.sql(f"CREATE OR REPLACE VIEW {table}_typed AS SELECT {columns} FROM {table}")


def _partitions(spark: SparkSession, folder: str, names: list[str]) -> list[list[str]]:
    """The innermost ``key=value`` folders below one batch that hold files, as lists of folder names."""
    inner = [n for n in keyed.list_dirs(spark, folder) if "=" in n]
    if inner:
        return [p for n in inner for p in _partitions(spark, f"{folder}/{n}", [*names, n])]
    return [names] if keyed.list_names(spark, folder) else []


def _spec(names: list[str]) -> str:
    parts = (n.split("=", 1) for n in names)
    return ", ".join(f"{ident(k)} = " + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{unquote(v)}'") for k, v in parts)


def _register_scd2(spark: SparkSession, table: str, risk: keyed.State) -> None:
    """The live buckets and the closed rows of a SCD2 store, as partitions with locations of their own."""
    where = {f"bucket-{b}": place for b, place in risk.live.items()}
    where |= {f"closed-{v}": p for v in risk.runs if keyed.exists(spark, p := f"{risk.root}/{v}/closed")}
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in merge.SCD2_SCHEMA.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}, piece string) USING PARQUET PARTITIONED BY (piece) LOCATION '{risk.root}'")
    done = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == BATCH_PROPERTY).first()
    seen = done["value"] if done else ""
    have = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # buckets and runs: few
    have = {unquote(h) for h in have}
    for piece in sorted(have - set(where)):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (piece = '{piece}')")
    for piece, place in sorted(where.items()):
        if piece not in have:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION (piece = '{piece}') LOCATION '{place}'")
        elif piece.startswith("bucket-") and place.split("/")[-3] > seen:
            spark.sql(f"ALTER TABLE {table} PARTITION (piece = '{piece}') SET LOCATION '{place}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BATCH_PROPERTY}' = '{risk.version}')")
    spark.catalog.refreshTable(table)


# ------------------------------------------------------------------ model, alerts, answers
def run_train(spark: SparkSession, paths: Paths, **options) -> DataFrame:
    """M1–M4, M6, M7: train on the gold features; the bundle and the run record go under the model folder."""
    features_table = spark.read.parquet(paths.gold("ml_features"))
    model, _, report, tables = ml.train(features_table, NUMERIC, **options)
    ml.save_bundle(model, report, paths.gold("model"), tables)
    ml.log_run(report, paths.gold("model_runs"), "train", len(CATEGORICAL) + len(NUMERIC) + len(tables))
    return report


def run_evaluate(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    """M5: the saved model and its threshold on the gold features, one output per artefact."""
    model = PipelineModel.load(f"{paths.gold('model')}/model")
    threshold = spark.read.json(f"{paths.gold('model')}/metrics").first()["best_threshold"]
    tables = {c: spark.read.parquet(f"{paths.gold('model')}/frequencies/{c}") for c in HASHED}
    results = ml.evaluate(model, spark.read.parquet(paths.gold("ml_features")), threshold, NUMERIC, frequencies=tables)
    ml.save_evaluation(results, paths.gold("evaluation"))
    return results


def run_alerts(spark: SparkSession, paths: Paths) -> DataFrame:
    """Control limit over the daily table; one JSON report with the flagged rows in full."""
    flags = quality.anomaly_flags(spark.read.parquet(paths.gold("daily_metrics")))
    report = quality.alert_report(flags)
    report.coalesce(1).write.mode("overwrite").json(paths.gold("alerts"))  # one row
    return report


def run_answers(spark: SparkSession, paths: Paths, questions: DataFrame, store: str, k: int = 3) -> DataFrame:
    """Answers of a question batch from the current document store and its index."""
    docs = read_documents(spark, store)
    ranked = textindex.search(spark, run_index(spark, store), questions, k=k, doc_key="id")
    answers = retrieve.answer_context(ranked, docs, questions=questions, doc_key="id")
    answers.write.mode("overwrite").json(paths.gold("answers"))
    return answers
