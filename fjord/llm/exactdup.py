"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

DataFrame functions only. The text column is scanned twice and never shuffled:

1. One scan writes (length, prefix hash) per row. Rows whose length no other
   row has drop out, then rows whose (length, prefix hash) is unique.
2. The surviving keys go into a bit set of fixed size, which the second scan
   reads by a broadcast join. Only rows that hit it are hashed in full; a few
   unique rows that hit by chance get a hash too and end up as groups of one.

Groups are counted with map-side partial aggregation, so a hot group sends one
row per task, and joined back to narrow rows (id, hash), where adaptive
skew-join splitting divides a hot hash.

Defined cases: a null text counts as empty; texts are equal when they agree
after lower-casing A-Z; a null id sorts below every id; of rows that tie on the
largest id exactly one is kept; an empty table gives no rows; other columns are
ignored except those named in ``carry``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import ascii_lower, bit_words, keep_rows, mark, row_key, stage

PREFIX = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: dict | None = None) -> DataFrame:
    """Per row: id, ``keep_id``, ``group_size``, ``kept`` and the ``carry`` columns.

    ``carry`` maps output names to Column expressions over ``docs``.
    """
    carry = carry or {}
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = [F.octet_length(text).alias("__n"),
            F.xxhash64(ascii_lower(F.substring(text, 1, PREFIX))).alias("__p")]
    narrow = stage(docs.select(*keys))

    lengths = narrow.groupBy("__n").count().filter("count > 1").select(F.xxhash64("__n").alias("__k"))
    by_length = mark(narrow.withColumn("__k", F.xxhash64("__n")), "__k", bit_words(lengths, "__k"), "__hit")
    prefixes = (by_length.filter("__hit").groupBy("__n", "__p").count().filter("count > 1")
                .select(F.xxhash64("__n", "__p").alias("__k")))
    survivors = stage(bit_words(prefixes, "__k"))

    scan = docs.select(F.col(id_col).alias("__id"), text.alias("__t"), *keys,
                       *[e.alias(c) for c, e in carry.items()])
    scan = mark(scan.withColumn("__k", F.xxhash64("__n", "__p")), "__k", survivors, "__hit")
    rows = stage(scan.select(
        "__id", F.monotonically_increasing_id().alias("__u"),
        F.when(F.col("__hit"), F.unhex(F.sha2(ascii_lower(F.col("__t")), 256))).alias("__h"), *carry))

    groups = stage(
        rows.filter("__h is not null").groupBy("__h")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("__id", "__u")).alias("__best"))
        .filter("group_size > 1"))
    hashed = rows.filter("__h is not null").join(groups, "__h", "left").select(
        F.col("__id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("__id")).otherwise(F.col("__best.__id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("__best.__u") == F.col("__u"), F.lit(True)).alias("kept"), *carry)
    alone = rows.filter("__h is null").select(
        F.col("__id").alias(id_col), F.col("__id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *carry)
    return hashed.unionByName(alone)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` does not keep.

    A row is found again by id and text hash; of repeated rows one stays.
    """
    out = exact_groups(docs, id_col, text_col, {"__x": row_key(text_col)})
    keep = (out.groupBy(F.col(id_col).alias("__i"), "__x")
            .agg(F.count("*").alias("__n"), F.bool_or("kept").alias("kept")).filter("kept"))
    return keep_rows(docs, stage(keep.select("__i", "__x", "__n")), id_col, text_col)
