"""A keyed Parquet store whose runs rewrite only the buckets they touch.

Rows live in buckets by a hash of their key. A run writes a folder of its own,

    v=<time>/current/<bucket>/     the rows of the buckets it touched, whole
    v=<time>/closed/               rows that are history from this run on (optional), written once
    v=<time>/commit/               the touched buckets and their row counts, written last

and nothing else, with Spark's own writers. It counts from the moment the
``_SUCCESS`` file of its commit table exists, so a run that dies changes
nothing. A bucket's rows are those of the newest run that touched it; the
history is the union of all closed rows. A run marked ``-full`` holds every
bucket and all history: older ones do not count any more. The first run is one,
and :func:`compact` writes one.

A run costs what it touches: reading and writing its buckets, and a listing of
the runs since the last full one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fjord.operators import merge
from fjord.session import reliable_checkpoint

BUCKETS = 64
BUCKET = "_fjord_bucket"
COMMIT = "bucket int, n long, buckets int"


@dataclass
class State:
    """The newest state of a store: the runs that make it up, and where every bucket's rows are."""

    root: str
    buckets: int
    runs: list[str]
    live: dict[int, str] = field(default_factory=dict)  # bucket -> folder; a bucket without rows has none

    @property
    def version(self) -> str:
        return self.runs[-1]


def file_system(spark: SparkSession, folder: str):
    """(Hadoop path, its file system)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Entry names of one folder (Hadoop file system listing: names only), hidden ones left out."""
    p, fs = file_system(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def list_dirs(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in one folder, hidden ones (``_``, ``.``) left out but for ``_batch_id=`` and its like."""
    p, fs = file_system(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n for n in names if "=" in n or not n.startswith(("_", ".")))


def new_version(full: bool = False) -> str:
    return "v=" + dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f") + ("-full" if full else "")


def complete_versions(spark: SparkSession, root: str, marker: str) -> list[str]:
    """Runs below ``root`` that hold ``marker``, oldest first; runs without a complete one mean damage and raise."""
    if not exists(spark, root):
        return []
    runs = [n for n in list_names(spark, root) if n.startswith("v=")]
    done = [v for v in runs if exists(spark, f"{root}/{v}/{marker}")]
    if runs and not done:
        raise RuntimeError(f"{root} has versions, but none was completely written")
    return done


def state(spark: SparkSession, root: str) -> State | None:
    """The current state, or None without any run."""
    runs = complete_versions(spark, root, "commit/_SUCCESS")
    if not runs:
        return None
    runs = runs[max(i for i, v in enumerate(runs) if v.endswith("-full")):]
    commits = spark.read.schema(COMMIT).parquet(*[f"{root}/{v}/commit" for v in runs])
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
    newest = commits.groupBy("bucket").agg(F.max(F.struct(run.alias("run"), "n", "buckets")).alias("c")).select("bucket", "c.*")
    rows = newest.collect()  # one row per bucket
    return State(root, rows[0]["buckets"], runs,
                 {r["bucket"]: f"{root}/{r['run']}/current/{BUCKET}={r['bucket']}" for r in rows if r["n"]})


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def read_current(spark: SparkSession, now: State | None, schema: T.StructType, only: list[int] | None = None) -> DataFrame:
    """The rows of all buckets, or of some."""
    live = now.live if now else {}
    paths = [p for b, p in sorted(live.items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_closed(spark: SparkSession, now: State | None, schema: T.StructType) -> DataFrame:
    """The history: the closed rows of all runs."""
    paths = [p for p in (f"{now.root}/{v}/closed" for v in (now.runs if now else [])) if exists(spark, p)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_run(spark: SparkSession, root: str, current: DataFrame, touched: list[int], key: str, buckets: int,
              full: bool, closed: DataFrame | None = None) -> str:
    """One run: the whole new rows of the touched buckets, the rows it closes, and the commit."""
    version = new_version(full)
    path = f"{root}/{version}"
    if closed is not None:
        closed.write.parquet(f"{path}/closed")
    rows = current.withColumn(BUCKET, bucket_of(key, buckets))
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/current")
    written = T.StructType([*current.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    counts = spark.read.schema(written).parquet(f"{path}/current").groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
    asked = spark.createDataFrame([(b,) for b in touched], "bucket int")  # at most the buckets of the store
    commit = asked.join(counts, F.col("bucket") == F.col(BUCKET), "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                                                       F.lit(buckets).alias("buckets"))
    commit.coalesce(1).write.parquet(f"{path}/commit")
    return version


def _touched(rows: DataFrame, key: str, buckets: int) -> list[int]:
    return sorted(r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect())


def upsert(spark: SparkSession, root: str, updates: DataFrame, key: str, buckets: int = BUCKETS) -> str:
    """K9: insert new keys, replace known ones; reads and writes the buckets of the updated keys only."""
    now = state(spark, root)
    buckets = now.buckets if now else buckets
    updates = reliable_checkpoint(updates)  # read twice: for its buckets and its rows
    touched = _touched(updates, key, buckets) if now else list(range(buckets))
    if not touched:
        return now.version
    merged = merge.upsert(read_current(spark, now, updates.schema, touched), updates, key)
    return write_run(spark, root, merged, touched, key, buckets, full=now is None)


def scd2(spark: SparkSession, root: str, source: DataFrame, at, mode: str = "single", buckets: int = BUCKETS,
         key: str = "account_hash") -> str:
    """Close changed rows and insert new ones; closed rows are written once, untouched buckets stay as they are."""
    now = state(spark, root)
    buckets = now.buckets if now else buckets
    changes = reliable_checkpoint(merge.scd2_changes(read_current(spark, now, merge.SCD2_SCHEMA), source, at, mode))
    closed, inserted = changes.filter(~F.col("is_current")), changes.filter("is_current")
    touched = _touched(changes, key, buckets) if now else list(range(buckets))
    if not touched:
        return now.version
    gone = closed.select(F.col(key).alias("__gone"))
    kept = read_current(spark, now, merge.SCD2_SCHEMA, touched)
    kept = kept.join(gone, F.col(key).eqNullSafe(F.col("__gone")), "left_anti")
    return write_run(spark, root, kept.unionByName(inserted), touched, key, buckets, now is None, closed)


def read_scd2(spark: SparkSession, root: str) -> DataFrame:
    """Current rows and history."""
    now = state(spark, root)
    return read_current(spark, now, merge.SCD2_SCHEMA).unionByName(read_closed(spark, now, merge.SCD2_SCHEMA))


def compact(spark: SparkSession, root: str, schema: T.StructType, key: str) -> str | None:
    """All live rows and all history in one new run, after which older runs do not count."""
    now = state(spark, root)
    if now is None:
        return None
    closed = read_closed(spark, now, schema) if any(exists(spark, f"{root}/{v}/closed") for v in now.runs) else None
    return write_run(spark, root, read_current(spark, now, schema), list(range(now.buckets)), key, now.buckets, True, closed)
