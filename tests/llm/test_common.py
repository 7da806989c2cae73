"""Shared helpers: the fixed-size bit set, row keys, staged tables."""

import os

from pyspark.sql import functions as F

from fjord.llm import common


def test_bit_words_mark_every_key(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("k"))
    words = common.bit_words(keys, "k")
    assert words.count() <= common.SKETCH_BITS // 64
    marked = common.mark(spark.range(20_000).select("id", F.xxhash64("id").alias("k")), "k", words, "hit")
    assert marked.filter("id < 5000 and not hit").count() == 0
    assert marked.filter("id >= 5000 and hit").count() < 50  # a few by chance
    assert common.mark(keys, "k", words.limit(0), "hit").filter("hit").count() == 0


def test_keep_rows(spark):
    docs = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (None, "a", 4), (None, None, 5)], "doc_id long, text string, n int")
    key = common.row_key("text")
    keep = docs.filter("n in (1, 4, 5)").groupBy(F.col("doc_id").alias("__i"), key.alias("__x")).agg(
        F.when(F.col("__i") == 1, 2).otherwise(1).alias("__n"))
    out = common.keep_rows(docs, keep)
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == [("1", "a"), ("None", "None"), ("None", "a")]


def test_ascii_lower(spark):
    rows = ["ABCxyz", "ÀÉabcXYZ", "", "İI", "ß", None]
    out = [r[0] for r in spark.createDataFrame([(r,) for r in rows], "t string").select(common.ascii_lower(F.col("t"))).collect()]
    assert out == ["abcxyz", "ÀÉabcxyz", "", "İi", "ß", None]


def test_staged_tables_are_swept(spark):
    staged = common.stage(spark.range(10))
    folder = common._STAGED[-1].removeprefix("file:")
    assert staged.count() == 10 and os.path.isdir(folder)
    assert common.sweep(spark) >= 1
    assert not os.path.exists(folder)
