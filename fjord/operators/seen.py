"""Dedup against everything stored before (D6): an anti-join that reads only days that may hold a key.

Every stored batch keeps a Bloom filter of its business keys per day, and one of
all keys up to and including its own. A filter is a table of at most ``words``
rows (word, bits): a key sets four bits of one 64-bit word, so filters are built
by a grouped ``bit_or`` and asked by an equi-join on the word; no Python, no
object on the driver.

A new batch first meets the filter of all keys, which has a fixed size and so is
broadcast; keys that miss it are new. Only the others meet the filters per day,
and only (batch, day) partitions with a hit are read, with their key columns, for
the exact anti-join. A full filter lets more through: that costs reading, never a
row. A key with a NULL in it is nobody's repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjord.functions.exprs import ident
from fjord.operators.clean import BUSINESS_KEY, dedup_first

WORDS = 1 << 20  # 64-bit words of a filter: at most 16 MB
FILTER = "word int, bits long"


def _key_known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(ident(k)).isNotNull()
    return known


def _word_and_mask(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word a key falls into and its four bits there."""
    h = F.xxhash64(*[F.col(ident(k)) for k in keys])
    spread = F.xxhash64(h, F.lit(1))
    bit = lambda i: F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.shiftright(spread, 6 * i).bitwiseAND(63).cast("int"))
    mask = bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))
    return F.pmod(h, F.lit(words)).cast("int"), mask


def dedup_known(df: DataFrame, keys: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """One row per business key, the smallest; rows with a NULL in the key all stay."""
    known = _key_known(keys)
    return dedup_first(df.filter(known), keys).unionByName(df.filter(~known))


def key_filter(rows: DataFrame, by: Sequence[str] = (), keys: Sequence[str] = BUSINESS_KEY, words: int = WORDS) -> DataFrame:
    """(``by``, word, bits): the Bloom filter of the keys of every group, map-side combined."""
    word, mask = _word_and_mask(keys, words)
    return (rows.filter(_key_known(keys)).select(*[F.col(ident(b)) for b in by], word.alias("word"), mask.alias("m"))
            .groupBy(*by, "word").agg(F.bit_or("m").alias("bits")))


def merged_filter(*filters: DataFrame) -> DataFrame:
    """The filter of all keys of several filters."""
    out = filters[0].select("word", "bits")
    for f in filters[1:]:
        out = out.unionByName(f.select("word", "bits"))
    return out.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def maybe_seen(rows: DataFrame, everything: DataFrame, keys: Sequence[str] = BUSINESS_KEY, words: int = WORDS) -> DataFrame:
    """(keys, word, mask) of the rows whose key passes a filter of at most ``words`` rows."""
    word, mask = _word_and_mask(keys, words)
    asked = rows.filter(_key_known(keys)).select(*[F.col(ident(k)) for k in keys], word.alias("word"), mask.alias("mask"))
    return _passing(asked, F.broadcast(everything.select("word", "bits")))


def _passing(asked: DataFrame, filters: DataFrame) -> DataFrame:
    return asked.join(filters, "word").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).drop("bits")


def unseen(rows: DataFrame, stored: DataFrame, everything: DataFrame, per_part: DataFrame, parts: Sequence[str],
           keys: Sequence[str] = BUSINESS_KEY, words: int = WORDS) -> DataFrame:
    """The rows whose key no stored row has.

    ``stored`` holds the stored keys and the partition columns ``parts``;
    ``everything`` is the filter of all its keys, ``per_part`` that of every
    partition. Partitions no key may be in are not read (dynamic partition
    pruning); stored rows that no asked key can equal drop out before the join.
    """
    asked = maybe_seen(rows, everything, keys, words)
    # the count's filter stays above the join, so the planner sees a selective side and prunes partitions by it
    hit = (_passing(asked.select("word", "mask").distinct(), per_part.select(*parts, "word", "bits"))
           .groupBy(*parts).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 0").select(*parts))
    word, mask = _word_and_mask(keys, words)
    found = (stored.join(F.broadcast(hit), list(parts))  # as many rows as there are partitions
             .select(*[F.col(ident(k)).alias(f"__k{i}") for i, k in enumerate(keys)], word.alias("word"), mask.alias("mask")))
    found = _passing(found, F.broadcast(merged_filter(asked.select("word", F.col("mask").alias("bits")))))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (rows[ident(k)] == found[f"__k{i}"])
    return rows.join(found, same, "left_anti")
