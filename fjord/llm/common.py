"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjord.session import ensure_checkpoint_dir, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A bit set of 2^24 bits in 64-bit words: at most 262,144 rows of two longs,
# whatever the size of the data, so it can always be broadcast.
SKETCH_BITS = 1 << 24
_STAGED: list[str] = []
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fjord-llm/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: later readers, and retries after a lost executor, read
    the written rows. Compressed Parquet keeps it smaller than checkpoint().
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    _STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> int:
    """Delete the tables this process staged so far; for jobs, once their results are written."""
    jvm, n = spark.sparkContext._jvm, 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        n += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, and rows in batches that fit them.

    A row holds a whole text, so Arrow batches of 1,000 rows and 32 MB (or one
    longer row) are used where the session does not say otherwise.
    """
    ship_package(spark)
    for key, value in ((BATCH, "1000"), (BATCH_BYTES, str(32 << 20))):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` (much faster) does the same for pure ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def bit_words(keys: DataFrame, key: str) -> DataFrame:
    """Bit set of the 64-bit hashes in ``key``: rows (word, bits), at most SKETCH_BITS / 64."""
    pos = F.pmod(F.col(key), F.lit(SKETCH_BITS))
    return (
        keys.select(F.shiftright(pos, 6).alias("word"),
                    F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    )


def mark(df: DataFrame, key: str, words: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: true for every row whose ``key`` is in the bit set (a few others pass too)."""
    w = F.broadcast(words.select(F.col("word").alias("__word"), F.col("bits").alias("__bits")))
    pos = F.pmod(F.col(key), F.lit(SKETCH_BITS))
    hit = F.coalesce(F.expr(f"shiftrightunsigned(__bits, cast(pmod({key}, 64) as int)) & 1L") == 1, F.lit(False))
    return df.join(w, F.shiftright(pos, 6) == F.col("__word"), "left").withColumn(flag, hit).drop("__word", "__bits")


def row_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def keep_rows(docs: DataFrame, keep: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand in ``keep`` (__i: id, __x: row_key, __n: how many such rows there are).

    Id and text hash find a row again whatever else its columns hold; ids may be
    null. Of rows that agree in both (repeated rows) one stays.
    """
    # the row travels as one struct, so its columns may have any names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").alias("id"), row_key(f"`{text_col}`").alias("key"))
    same = F.col("id").eqNullSafe(F.col("__i")) & (F.col("key") == F.col("__x"))
    out = rows.join(keep.filter("__n = 1").select("__i", "__x"), same, "left_semi")
    twins = keep.filter("__n > 1").select("__i", "__x")
    if not twins.isEmpty():
        out = out.unionByName(rows.join(twins, same, "left_semi").dropDuplicates(["id", "key"]))
    return out.select("row.*")
