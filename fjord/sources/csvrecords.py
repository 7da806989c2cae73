"""CSV lines bound to records and to the header of their own file.

Lines of many files, each with its own header, become one table:

1. One pass sums up every split of every file: how many of its lines hold an odd
   number of quotes, and its first line that is not blank.
2. A prefix sum of that parity over the splits of a file tells whether a split
   begins inside quotes. Inside a split the same sum tells it for every line, so
   a record that spans lines, or splits, is put together from its lines.
   Files without an odd line need none of this and are not shuffled.
3. Where the quotes of a file do not pair up (or a record would grow beyond
   MAX_RECORD), it cannot be told which lines belong together. Then every line
   stands alone; one with an unpaired quote, or whose number of fields is not
   the header's, is rescued whole, none is cut.
4. All records are parsed once, whatever the number of headers: a join with the
   file's list of names turns the fields into a map from name to value.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fjord.session import reliable_checkpoint
from fjord.sources import schema as S

EXTRA_FIELDS = 32  # fields beyond the header that are rescued one by one; a row with more keeps its raw line
MAX_FIELDS = 10_000  # a feed with more distinct field names is taken for a mistake
MAX_RECORD = 1 << 20  # characters of a record that spans lines; a longer one is taken for an unclosed quote
_TOLD = r"[^\s﻿]"  # other lines are blank, as for Spark's CSV reader
_QUOTE = r'(?<!\\)"'  # a quote that is not escaped


def _numbered(lines: DataFrame) -> DataFrame:
    odd = F.regexp_count("value", F.lit(_QUOTE)) % 2
    return lines.select("value", "_source_file", "_block", F.monotonically_increasing_id().alias("__n"), odd.alias("__odd"))


def split_summary(lines: DataFrame) -> DataFrame:
    """One row per split: (_source_file, _block, odd lines, first line that is not blank); a small table, staged."""
    told = F.when(F.col("value").rlike(_TOLD), F.struct("__n", "value"))
    return reliable_checkpoint(_numbered(lines).groupBy("_source_file", "_block").agg(
        F.sum("__odd").alias("odd"), F.min(told)["value"].alias("first")))


def file_headers(splits: DataFrame) -> DataFrame:
    """One row per file: (_source_file, header, whether its quotes pair up, whether records may span lines)."""
    first = F.min(F.when(F.col("first").isNotNull(), F.struct("_block", "first")))["first"]
    files = splits.groupBy("_source_file").agg(F.sum("odd").alias("odd"), first.alias("header")).filter("header is not null")
    paired = (F.col("odd") % 2 == 0) & (F.regexp_count("header", F.lit(_QUOTE)) % 2 == 0)
    return files.select("_source_file", "header", paired.alias("paired"), (paired & (F.col("odd") > 0)).alias("spans"))


def records(lines: DataFrame, splits: DataFrame, files: DataFrame) -> DataFrame:
    """(_source_file, header, value, alone): one row per record; ``alone`` marks lines of files whose quotes do not pair up."""
    if files.filter("spans").isEmpty():
        plain = lines.join(files, "_source_file")
        return plain.select("_source_file", "header", "value", (~F.col("paired")).alias("alone"))

    of_file = Window.partitionBy("_source_file").orderBy("_block")  # over splits
    inside = splits.select("_source_file", "_block", F.coalesce(
        F.sum("odd").over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    of_split = Window.partitionBy("_source_file", "_block").orderBy("__n")
    so_far = F.coalesce(F.sum("__odd").over(of_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tagged = (_numbered(lines).join(files, "_source_file").join(inside, ["_source_file", "_block"])
              .withColumn("open", F.when(F.col("paired"), (F.col("before") + so_far) % 2).otherwise(0)))
    number = F.sum((F.col("open") == 0).cast("long")).over(of_split.rowsBetween(Window.unboundedPreceding, 0))
    tagged = reliable_checkpoint(tagged.select("_source_file", "_block", "__n", "__odd", "header", "paired", "open", "value",
                                               number.alias("number")))  # read four times; the files once

    # lines at the head of a split that go on with the last record of an earlier one
    starts = tagged.groupBy("_source_file", "_block").agg(F.max("number").alias("starts"))
    earlier = F.last(F.when(F.col("starts") > 0, F.struct("_block", "starts")), ignorenulls=True).over(
        of_file.rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("_source_file", "_block", earlier.alias("earlier"))
    whole = (F.col("open") == 0) & ((F.col("__odd") == 0) | ~F.col("paired"))
    parts = tagged.filter(~whole).join(starts, ["_source_file", "_block"])
    begun = F.col("number") > 0
    parts = parts.select("_source_file", "header", "_block", "__n", "value",
                         F.when(begun, F.struct("_block", F.col("number").alias("starts"))).otherwise(F.col("earlier")).alias("record"))

    size = parts.groupBy("_source_file", "record").agg(F.sum(F.length("value") + 1).alias("size"))
    endless = size.filter(F.col("size") > MAX_RECORD).select("_source_file").distinct()
    pieces = F.array_sort(F.collect_list(F.struct("_block", "__n", "value")))
    joined = (parts.join(endless, "_source_file", "left_anti").groupBy("_source_file", "header", "record")
              .agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value")))
    singles = tagged.filter(whole).join(endless.withColumn("endless", F.lit(True)), "_source_file", "left")
    alone = ~F.col("paired") | F.coalesce("endless", F.lit(False))
    return (joined.select("_source_file", "header", "value", F.lit(False).alias("alone"))
            .unionByName(singles.select("_source_file", "header", "value", alone.alias("alone")))
            .unionByName(parts.join(endless, "_source_file", "left_semi")
                         .select("_source_file", "header", "value", F.lit(True).alias("alone"))))


def column_names(header: str) -> list[str]:
    """The names of a header line; an empty one gets its position, a repeated one its position as well."""
    names: list[str] = []
    if header.replace('\\"', "").count('"') % 2:
        return names  # a header that does not end on its line
    for i, name in enumerate(next(csv.reader([header.lstrip("﻿")]), [])):
        name = name or f"_c{i}"
        names.append(f"{name}_{i}" if name in names else name)
    return names


def csv_by_header(lines: DataFrame, hints) -> DataFrame | None:
    """CSV lines bound by the header of *their own* file, typed by hint, with rescue; None without rows.

    ``lines`` has value, _source_file and _block (where the split of the line
    starts in its file). Only distinct headers reach the driver (one per version
    of the feed; more than ``MAX_FIELDS`` raise). A column missing in a file is
    NULL. Fields beyond the header, values that do not fit their hint, and lines
    that cannot be taken apart go to ``_rescued_data``.
    """
    splits = split_summary(lines)
    files = file_headers(splits)
    headers = [r[0] for r in files.select("header").distinct().limit(MAX_FIELDS + 1).collect()]
    if len(headers) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} distinct headers in one batch: do the files have headers?")
    if not headers:
        return None
    spark, names = lines.sparkSession, {h: column_names(h) for h in sorted(headers)}
    rows = records(lines, splits, files).filter(F.col("value").rlike(_TOLD) & (F.col("value") != F.col("header")))
    known = spark.createDataFrame(list(names.items()), "header string, names array<string>")
    parsed = _parsed(rows.join(F.broadcast(known), "header"), names)  # as many rows as distinct headers
    columns = list(dict.fromkeys(n for h in names for n in names[h]))
    extras = {f"_extra_{i + 1}": F.col(f"__extra_{i + 1}") for i in range(EXTRA_FIELDS)}
    typed = parsed.select(*[F.try_element_at("__m", F.lit(c)).alias(c) for c in columns], "_source_file",
                          *[F.get(F.col("__more"), F.lit(i)).alias(f"__extra_{i + 1}") for i in range(EXTRA_FIELDS)], "__raw")
    out = S.with_rescue(typed, hints, extra=extras | {"_raw": F.col("__raw")})
    return out.drop(*[f"__extra_{i + 1}" for i in range(EXTRA_FIELDS)], "__raw")


def _parsed(rows: DataFrame, names: Mapping[str, list[str]]) -> DataFrame:
    """(_source_file, __m: name to value, __more: fields beyond the header, __raw: the text of a row that is not whole)."""
    width = max(map(len, names.values())) + EXTRA_FIELDS
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    n = F.size("names")
    outside = F.regexp_replace("value", '"[^"]*"', "")
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    odd = F.regexp_count("value", F.lit(_QUOTE)) % 2 == 1
    lost = (n == 0) | F.col("alone") & (odd | (fields != n))
    # a quote inside quotes is doubled or, where the record says so, escaped
    doubled = F.from_csv("value", F.lit(schema.toDDL()), {"escape": '"'})
    escaped = F.from_csv("value", F.lit(schema.toDDL()))
    rows = rows.withColumn("__lost", lost).withColumn("__f", F.when(~F.col("__lost"), F.when(
        F.contains("value", F.lit('\\"')), escaped).otherwise(doubled)))
    values = F.array(*[F.col(f"__f.c{i}") for i in range(width)])
    rows = rows.select("_source_file", "value", "names", "__lost", F.when(~F.col("__lost"), values).alias("__v"))
    more = F.slice(F.col("__v"), n + 1, F.lit(EXTRA_FIELDS))
    return rows.select(
        "_source_file", F.when(~F.col("__lost"), F.map_from_arrays("names", F.slice(F.col("__v"), F.lit(1), n))).alias("__m"),
        more.alias("__more"),
        F.when(F.col("__lost") | F.get(more, F.lit(EXTRA_FIELDS - 1)).isNotNull(), F.col("value")).alias("__raw"))
