"""Types of unhinted text columns (S5): a lattice folded by partial aggregation and kept in the schema memory.

Every value is a set of the types it reads as without loss, written as bits; a
column's set is what all its values share (``bit_and``, a partial aggregate), its
type the narrowest one in it:

    int < bigint     int < double     date < timestamp     boolean     all < string

So the type depends on the values alone, not on how they are dealt over tasks,
batches or runs. A number with a leading zero or plus sign, or with more digits
than a double keeps, is text. The memory keeps the sets and folds new ones in;
columns only widen. Files hold the text as it came and are never rewritten: the
types of the moment are applied where the table is read.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjord.functions.exprs import ident

TYPES = ["int", "bigint", "double", "boolean", "date", "timestamp"]  # bit i of a set; the narrowest first
WHOLE = r"^(0|-?[1-9][0-9]{0,18})$"
DECIMAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?$"
EXACT_DIGITS = 15


def type_set(value: Column) -> Column:
    """The types a text reads as without loss, as bits; NULL for NULL."""
    fits = [
        value.rlike(WHOLE) & value.try_cast("int").isNotNull(),
        value.rlike(WHOLE) & value.try_cast("bigint").isNotNull(),
        value.rlike(DECIMAL) & (F.length(F.regexp_replace(value, "[^0-9]", "")) <= EXACT_DIGITS),
        value.isin("true", "false"),
        value.rlike(DAY) & value.try_cast("date").isNotNull(),
        value.rlike(TIME) & value.try_cast("timestamp").isNotNull(),
    ]
    out = F.lit(0)
    for i, f in enumerate(fits):
        out = out + F.when(f, F.lit(1 << i)).otherwise(F.lit(0))
    return F.when(value.isNotNull(), out)


def column_sets(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, column, types): the types all values of a column share; NULL where it has none. One pass, one row per task."""
    folded = df.groupBy(*by).agg(*[F.bit_and(type_set(F.col(ident(c)))).alias(f"s{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("types")) for i, c in enumerate(columns)])
    return folded.select(*by, F.inline(rows))


def type_name(types: Column) -> Column:
    """The narrowest type of a set; ``void`` where there was no value."""
    out = F.when(types.isNull(), F.lit("void"))
    for i, t in enumerate(TYPES):
        out = out.when(types.bitwiseAND(1 << i) != 0, F.lit(t))
    return out.otherwise(F.lit("string"))


def narrowest(types: int | None) -> str:
    """:func:`type_name` of one number."""
    return "void" if types is None else next((t for i, t in enumerate(TYPES) if types >> i & 1), "string")


# ------------------------------------------------------------------ memory
def load_sets(spark: SparkSession, path: str) -> dict[str, int]:
    """The remembered sets: every line ever saved, folded; empty on the first run."""
    try:
        lines = spark.read.text(path).collect()  # a line per batch that narrowed something: few
    except AnalysisException:
        return {}
    out: dict[str, int] = {}
    for r in lines:
        for c, t in json.loads(r[0])["types"].items():
            out[c] = out.get(c, t) & t
    return out


def remember(spark: SparkSession, path: str, found: Mapping[str, int]) -> dict[str, int]:
    """Fold new sets into the memory; only appends, and only when something changes."""
    old = load_sets(spark, path)
    new = {c: old.get(c, t) & t for c, t in found.items()}
    if any(old.get(c) != t for c, t in new.items()):
        line = json.dumps({"saved": dt.datetime.now(dt.timezone.utc).isoformat(), "types": new})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)
    return old | new


def typed(df: DataFrame, sets: Mapping[str, int]) -> DataFrame:
    """Text columns under their remembered types; all others as they are."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(ident(c)).cast(t).alias(c) if kinds[c] == "string" and c in sets
                       and (t := narrowest(sets[c])) not in ("string", "void") else F.col(ident(c)) for c in df.columns])
