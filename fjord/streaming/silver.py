"""Silver: bronze table as a stream → good + quarantine tables via ``foreachBatch``.

Replay safety (SURVEY D5): a micro-batch can run again after a failure. Each
batch therefore writes with plain ``overwrite`` into its own directory
``<table>/_batch_id=<id>/`` — for good and quarantine alike, even when that
side is empty — so a replay replaces exactly its own earlier attempt and
leaves every other batch alone. The batch is persisted before its first
action and ``as_of`` is pinned from the batch's ingestion date, so a replay
after midnight selects the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from fjord.functions.exprs import ident
from fjord.operators import clean, seen
from fjord.session import reliable_checkpoint
from fjord.sources import keyed


def bounded(reader: DataStreamReader, max_files_per_trigger: int | None) -> DataStreamReader:
    return reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader


def batch_as_of(batch: DataFrame, as_of=None):
    """The pinned 'today' of a batch: explicit, else the latest ingestion date it carries."""
    if as_of is not None:
        return as_of
    if "_ingestion_date" in batch.columns:
        d = batch.agg(F.max("_ingestion_date")).first()[0]
        if d is not None:
            return d
    return None


def process_batch(batch: DataFrame, batch_id: int, good_path: str, quarantine_path: str,
                  as_of=None, strict: bool = False, partition_col: str = "TransactionDate",
                  names: Mapping[str, str] | None = None, across_batches: bool = False) -> dict:
    """K2: split one micro-batch into good (date-partitioned) and quarantine outputs.

    With ``across_batches`` (D6) a good row whose business key an earlier batch
    has stored is dropped, and rows with a NULL in the key are never taken for
    repeats of each other. Only batches of smaller number count, so a replay
    gives the same rows.

    ``names`` turns the names of the feed into those the rules use. The time of
    day is kept as ``TransactionTimestamp``; the date column is a day. Rows are
    rebalanced by day before the write: few files per day, and a hot day is
    split over several tasks.
    """
    batch = batch.select(*[F.col(ident(c)).alias((names or {}).get(c, c)) for c in batch.columns])
    if "TransactionDate" in batch.columns:
        batch = batch.withColumn("TransactionTimestamp", F.col("TransactionDate").try_cast("timestamp"))
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pinned = batch_as_of(batch, as_of)
        if across_batches:
            good = new_good_rows(batch, batch_id, good_path, pinned, strict, partition_col)
        else:
            good = clean.silver_good(batch, as_of=pinned, strict=strict)
        bad = clean.silver_quarantine(batch, as_of=pinned, strict=strict)
        (good.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col)
             .parquet(f"{good_path}/_batch_id={batch_id}"))
        bad.write.mode("overwrite").parquet(f"{quarantine_path}/_batch_id={batch_id}")
        if across_batches:
            write_filters(batch.sparkSession, good_path, batch_id, partition_col)
        return {"batch_id": batch_id, "as_of": str(pinned)}
    finally:
        batch.unpersist()


# ------------------------------------------------------------------ repeats across batches
def _filters(good_path: str, kind: str) -> str:
    return f"{good_path.rstrip('/')}_keys/{kind}"


def _batches(spark: SparkSession, path: str, below: int) -> list[int]:
    """Numbers of the batches stored at ``path``, smaller than ``below``."""
    found = keyed.list_dirs(spark, path) if keyed.exists(spark, path) else []
    return sorted(b for b in (int(n.rpartition("=")[2]) for n in found if n.startswith("_batch_id=")) if b < below)


def _stored_keys(spark: SparkSession, good_path: str, partition_col: str, batches: list[int]) -> DataFrame:
    """Key and partition columns of stored batches."""
    keys = T.StructType([T.StructField(k, T.StringType()) for k in clean.BUSINESS_KEY])
    schema = T.StructType([*keys.fields, T.StructField(partition_col, T.DateType()), T.StructField("_batch_id", T.IntegerType())])
    return spark.read.schema(schema).parquet(good_path).filter(F.col("_batch_id").isin(batches))


def new_good_rows(batch: DataFrame, batch_id: int, good_path: str, as_of, strict: bool, partition_col: str) -> DataFrame:
    """Good rows, one per business key, that no earlier batch has stored."""
    spark = batch.sparkSession
    rows = clean.defensive_cast(batch.filter(clean.good_condition(batch, as_of, strict)))
    good = seen.dedup_known(rows)
    before = _batches(spark, good_path, batch_id)
    if not before:
        return good
    missing = set(before) - set(_batches(spark, _filters(good_path, "all"), batch_id))
    for b in sorted(missing):  # stored before the option was used, or by a run that died
        write_filters(spark, good_path, b, partition_col)
    everything = spark.read.schema(seen.FILTER).parquet(f"{_filters(good_path, 'all')}/_batch_id={before[-1]}")
    per_day = (spark.read.schema(f"`{partition_col}` date, {seen.FILTER}, _batch_id int").parquet(_filters(good_path, "days"))
               .filter(F.col("_batch_id").isin(before)))
    stored = _stored_keys(spark, good_path, partition_col, before)
    # staged: the rows are read from where the next batch will look for them, and written beside it
    return reliable_checkpoint(seen.unseen(good, stored, everything, per_day, ["_batch_id", partition_col]))


def write_filters(spark: SparkSession, good_path: str, batch_id: int, partition_col: str) -> None:
    """The filters of one stored batch: per day, and of all keys up to this batch (the previous one's and its own)."""
    days, everything = _filters(good_path, "days"), _filters(good_path, "all")
    stored = _stored_keys(spark, good_path, partition_col, [batch_id])
    schema = f"`{partition_col}` date, {seen.FILTER}"
    (seen.key_filter(stored, [partition_col]).sortWithinPartitions("word")
         .write.mode("overwrite").parquet(f"{days}/_batch_id={batch_id}"))
    own = spark.read.schema(schema).parquet(f"{days}/_batch_id={batch_id}")
    before = _batches(spark, everything, batch_id)
    parts = [own] + [spark.read.schema(seen.FILTER).parquet(f"{everything}/_batch_id={b}") for b in before[-1:]]
    seen.merged_filter(*parts).write.mode("overwrite").parquet(f"{everything}/_batch_id={batch_id}")


def run_silver(spark: SparkSession, bronze_path: str, good_path: str, quarantine_path: str,
               checkpoint: str, as_of=None, strict: bool = False, timeout: float | None = None,
               names: Mapping[str, str] | None = None, max_files_per_trigger: int | None = None,
               across_batches: bool = False) -> StreamingQuery:
    """The bronze table read as a stream (schema from the table), availableNow.

    ``bronze_path`` is a Parquet path, or ``table:<name>`` for a registered
    table (S9, ``readStream.table``).
    """
    if bronze_path.startswith("table:"):
        src = bounded(spark.readStream, max_files_per_trigger).table(bronze_path[len("table:"):])
    else:
        schema = spark.read.option("mergeSchema", "true").parquet(bronze_path).schema
        src = bounded(spark.readStream, max_files_per_trigger).schema(schema).parquet(bronze_path)
    q = (src.writeStream
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .queryName("silver_processing")
            .foreachBatch(lambda df, bid: process_batch(df, bid, good_path, quarantine_path, as_of, strict,
                                                         names=names, across_batches=across_batches))
            .start())
    q.awaitTermination(timeout)
    return q


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a silver table (all batches; partition columns recovered)."""
    return spark.read.option("mergeSchema", "true").parquet(path)
