"""Bronze: incremental file ingestion into an append-only Parquet table.

A Structured Streaming file source remembers, in its checkpoint, which files
it has processed, so each run (``availableNow``) ingests only new files. Every
micro-batch writes with plain overwrite into its own ``_bronze_batch_id=<id>``
directory, so a replay replaces exactly its own attempt (the name differs from
silver's ``_batch_id`` directories: it passes through silver as lineage).

The schema grows inside the micro-batch. A JSON batch is parsed once into maps,
kept while its field names are gathered and folded into the schema memory; then
the maps become columns, unknown or ill-typed fields go to ``_rescued_data``. A
CSV batch binds every record by the header of its own file
(``fjord.sources.csvrecords``). Fields without a hint are stored as text; the
types their values share are kept beside the schema memory and applied by
``read_bronze`` (``fjord.sources.inference``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fjord.functions.constants import PIPELINE_VERSION
from fjord.sources import inference
from fjord.sources import schema as S
from fjord.sources.csvrecords import MAX_FIELDS, csv_by_header

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
          "integer": T.IntegerType(), "bigint": T.LongType(), "timestamp": T.TimestampType(),
          "date": T.DateType(), "boolean": T.BooleanType()}
BATCH = "_bronze_batch_id"
METADATA = ["_ingestion_timestamp", "_ingestion_date", "_source_file", "_environment", "_pipeline_version", "_rescued_data", BATCH]


def observed_fields(maps: DataFrame, hints: Mapping[str, str] | str, column: str = "__m") -> T.StructType:
    """Keys present in a column of maps, typed by hint (else text), in first-seen order."""
    h = S.parse_hints(hints)
    entries = maps.select(F.posexplode(F.map_entries(column)).alias("pos", "e"))
    # nested objects / arrays never become columns: they stay in the rescue
    nested = F.col("e.value").startswith("{") | F.col("e.value").startswith("[")
    keys = (entries.groupBy(F.col("e.key").alias("k"))
                   .agg(F.min("pos").alias("pos"), F.max(nested.cast("int")).alias("nested"))
                   .filter("nested = 0").orderBy("pos", "k"))
    names = [r["k"] for r in keys.limit(MAX_FIELDS + 1).collect()]  # distinct field names only
    if len(names) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} distinct fields in one batch: are values used as names?")
    return T.StructType([T.StructField(n, _TYPES.get(h.get(n, "string"), T.StringType())) for n in names])


def with_ingest_metadata(df: DataFrame, environment: str, version: str = PIPELINE_VERSION,
                         source_col: str = "_source_file") -> DataFrame:
    """S8 + P3: ingestion time/date, source file, environment, pipeline version."""
    out = (df.withColumn("_ingestion_timestamp", F.current_timestamp())
             .withColumn("_ingestion_date", F.current_date())
             .withColumn("_environment", F.lit(environment))
             .withColumn("_pipeline_version", F.lit(version)))
    if "IP Address" in out.columns:
        out = out.withColumnRenamed("IP Address", "IP_Address")
    return out


def read_csv_stream(spark: SparkSession, landing: str, columns: list[str], hints,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """S4 for a fixed-header CSV feed: strings by header, then hints and rescue.

    CSV binds columns by position under an explicit schema, so this is only
    for feeds whose header does not drift; ``enforceSchema=false`` makes a
    drifted header fail the batch instead of loading it silently wrong. A
    drifting feed uses ``run_bronze_csv``.
    """
    string_schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.readStream.schema(string_schema).option("header", "true").option("enforceSchema", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing).withColumn("_source_file", F.col("_metadata.file_path"))
    return S.with_rescue(raw, hints)  # _source_file is unhinted: passes through


def _run(spark: SparkSession, landing: str, pattern: str, table_path: str, checkpoint: str, name: str,
         bind: Callable[[DataFrame], DataFrame | None], memory: str | None, hints, environment: str,
         max_files_per_trigger: int | None, timeout: float | None) -> StreamingQuery:
    """K1 + T1–T3 + T5: new files as lines, micro-batch by micro-batch into the table, then stop."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landing).select("value", F.col("_metadata.file_path").alias("_source_file"),
                                        F.col("_metadata.file_block_start").alias("_block"))

    def batch(df: DataFrame, batch_id: int) -> None:
        data = bind(df)
        if data is not None:
            path = f"{table_path}/{BATCH}={batch_id}"
            with_ingest_metadata(data, environment).write.mode("overwrite").parquet(path)
            if memory is not None:
                remember_types(df.sparkSession, path, memory, hints)

    q = (lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
              .queryName(name).foreachBatch(batch).start())
    q.awaitTermination(timeout)
    return q


def remember_types(spark: SparkSession, path: str, memory: str, hints) -> dict[str, int]:
    """Fold the types of a written batch's unhinted text columns into the memory; reads only those columns."""
    h = S.parse_hints(hints)
    stored = spark.read.parquet(path)
    names = {"IP_Address" if c == "IP Address" else c for c in h}
    asked = [c for c, t in stored.dtypes if t == "string" and c not in names and c not in METADATA]
    if not asked:
        return inference.load_sets(spark, f"{memory}/types")
    found = {r["column"]: r["types"] for r in inference.column_sets(stored, asked).collect() if r["types"] is not None}
    return inference.remember(spark, f"{memory}/types", found)


def run_bronze_csv(spark: SparkSession, landing: str, table_path: str, checkpoint: str, hints,
                   environment: str = "test", max_files_per_trigger: int | None = None,
                   timeout: float | None = None, memory: str | None = None) -> StreamingQuery:
    """S4–S8 for a CSV feed whose header may drift between files.

    New columns appear as new Parquet columns; ``read_bronze`` merges schemas.
    No file is opened on the driver; compressed files are read like others.
    """
    return _run(spark, landing, "*.csv*", table_path, checkpoint, "bronze_csv", lambda df: csv_by_header(df, hints),
                memory, hints, environment, max_files_per_trigger, timeout)


def run_bronze(spark: SparkSession, landing: str, table_path: str, memory: str, checkpoint: str,
               hints, environment: str = "test", timeout: float | None = None,
               max_files_per_trigger: int | None = None) -> T.StructType:
    """One JSON bronze run; returns the schema memory it leaves."""

    def bind(df: DataFrame) -> DataFrame:
        while kept:
            kept.pop().unpersist()
        parsed = df.withColumn("__m", F.from_json("value", T.MapType(T.StringType(), T.StringType())))
        kept.append(parsed.persist(StorageLevel.MEMORY_AND_DISK))  # the lines are parsed once, not for names and values
        schema = S.evolve_schema(spark, f"{memory}/schema", observed_fields(kept[-1], hints))
        return S.rescue_json_maps(kept[-1].drop("_block"), schema)

    kept: list[DataFrame] = []
    try:
        _run(spark, landing, "*", table_path, checkpoint, "bronze", bind, memory, hints, environment,
             max_files_per_trigger, timeout)
    finally:
        for df in kept:
            df.unpersist()
    return S.load_schema(spark, f"{memory}/schema") or T.StructType([])


def read_bronze(spark: SparkSession, table_path: str, memory: str | None = None) -> DataFrame:
    """Batch read of the bronze table; files written before an evolution lack new columns.

    With ``memory`` unhinted columns have the types remembered there, whatever
    they were when a file was written.
    """
    found = spark.read.option("mergeSchema", "true").parquet(table_path)
    return found if memory is None else inference.typed(found, inference.load_sets(spark, f"{memory}/types"))
