"""Schema hints, rescued data and schema memory for file ingestion.

Plain Spark has no rescued-data column and no schema memory; this module
builds both from built-ins:

* hints — read as strings, then ``try_cast`` the hinted columns (S5);
* rescue — a JSON object of only the fields whose value did not fit its type
  or whose name is not in the schema; NULL when nothing was rescued (S6);
* memory — the merged schema is stored as JSON next to the table and only
  ever grows (additive evolution, S7).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fjord.functions.exprs import ident

_TYPE_ALIASES = {"integer": "int", "long": "bigint", "short": "smallint"}


def parse_hints(hints: str | Mapping[str, str]) -> dict[str, str]:
    """``"a double, b int"`` or a mapping → {column: spark type name}."""
    if isinstance(hints, Mapping):
        return {k: _TYPE_ALIASES.get(v.lower(), v.lower()) for k, v in hints.items()}
    st = T.StructType.fromDDL(hints)
    return {f.name: f.dataType.simpleString() for f in st.fields}


def apply_hints(df: DataFrame, hints: str | Mapping[str, str], default: str = "string") -> DataFrame:
    """Hinted columns typed with ``try_cast``; unhinted keep ``default``."""
    h = parse_hints(hints)
    out = []
    for c in df.columns:
        t = h.get(c, default)
        col = F.col(ident(c))
        out.append((col if t == "string" else col.try_cast(t)).alias(c))
    return df.select(*out)


def rescue_column(df: DataFrame, hints: str | Mapping[str, str], extra: Mapping[str, Column] | None = None) -> Column:
    """S6 over string columns: JSON of the hinted fields that failed their cast, and of non-NULL ``extra`` values."""
    h = parse_hints(hints)
    checked = [c for c in df.columns if h.get(c, "string") != "string"]
    entries = F.array(*[
        F.when(F.col(ident(c)).isNotNull() & F.col(ident(c)).try_cast(h[c]).isNull(),
               F.struct(F.lit(c).alias("k"), F.col(ident(c)).alias("v")))
        for c in checked],
        *[F.when(v.isNotNull(), F.struct(F.lit(k).alias("k"), v.alias("v"))) for k, v in (extra or {}).items()])
    failed = F.filter(entries, lambda e: e.isNotNull())
    return F.when(F.size(failed) > 0, F.to_json(F.map_from_entries(failed)))


def with_rescue(df: DataFrame, hints: str | Mapping[str, str], rescue: str = "_rescued_data",
                extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Typed columns plus the rescue JSON, one projection (no shuffle)."""
    h = parse_hints(hints)
    cols = []
    for c in df.columns:
        t = h.get(c, "string")
        col = F.col(ident(c))
        cols.append((col if t == "string" else col.try_cast(t)).alias(c))
    return df.select(*cols, rescue_column(df, hints, extra).alias(rescue))


def rescue_json_lines(lines: DataFrame, schema: T.StructType, rescue: str = "_rescued_data",
                      value: str = "value") -> DataFrame:
    """Parse JSON text lines against ``schema`` with rescue.

    Each line becomes ``map<string,string>`` (nested objects stay as JSON
    text). A field lands in the rescue object when its key is not in the
    schema or its non-NULL value does not cast to the declared type. A line
    that is not a JSON object is rescued whole as ``{"_raw": line}``.
    """
    m = F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()))
    return rescue_json_maps(lines.withColumn("__m", m), schema, rescue, value)


def rescue_json_maps(parsed: DataFrame, schema: T.StructType, rescue: str = "_rescued_data", value: str = "value") -> DataFrame:
    """:func:`rescue_json_lines` of lines that have been parsed into the map ``__m``."""
    known = {f.name: f.dataType.simpleString() for f in schema.fields}
    typed = []
    for f in schema.fields:
        raw = F.col("__m").getItem(f.name)
        typed.append((raw if isinstance(f.dataType, T.StringType) else raw.try_cast(f.dataType)).alias(f.name))
    names = F.array(*[F.lit(n) for n in known])

    def bad(k, v):
        cast_ok = F.lit(True)
        for n, t in known.items():
            if t != "string":
                cast_ok = F.when(k == F.lit(n), v.try_cast(t).isNotNull()).otherwise(cast_ok)
        return ~F.array_contains(names, k) | (v.isNotNull() & ~cast_ok)

    rescued_map = F.map_filter("__m", bad)
    rescued = (F.when(F.col("__m").isNull() & F.col(value).isNotNull(),
                      F.to_json(F.create_map(F.lit("_raw"), F.col(value))))
               .when(F.size(rescued_map) > 0, F.to_json(rescued_map)))
    keep = [c for c in parsed.columns if c not in (value, "__m")]
    return parsed.select(*[F.col(ident(c)) for c in keep], *typed, rescued.alias(rescue))


# ------------------------------------------------------------------ memory
# The schema memory is a folder of one-line text files written through Spark, so it lives
# on whatever shared filesystem the path names (HDFS, object store, local).
def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The remembered schema, or None on the first run.

    Every version is appended as a line of its own and none is overwritten, so
    a run that dies while saving leaves the earlier ones; the memory is their
    merge, oldest first. A folder whose lines are gone raises.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return None
    rows = sorted(json.loads(r[0])["saved"] + "\n" + r[0] for r in lines.collect())  # a line per evolution: few
    if not rows:
        raise RuntimeError(f"the schema memory at {path} is empty; restore it before ingesting")
    merged = None
    for r in rows:
        merged = merge_schemas(merged, T.StructType.fromJson(json.loads(r.split("\n", 1)[1])["schema"]))
    return merged


def merge_schemas(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """S7 additive evolution: keep every known field (and its type), append new ones."""
    if old is None:
        return new
    names = {f.name for f in old.fields}
    return T.StructType(list(old.fields) + [f for f in new.fields if f.name not in names])


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    line = json.dumps({"saved": dt.datetime.now(dt.timezone.utc).isoformat(), "schema": schema.jsonValue()})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)


def evolve_schema(spark: SparkSession, path: str, observed: T.StructType) -> T.StructType:
    """Merge the observed schema into memory before a run; never mid-run (hard part 5)."""
    old = load_schema(spark, path)
    merged = merge_schemas(old, observed)
    if old is None or merged != old:
        save_schema(spark, path, merged)
    return merged


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """By-name union; columns missing on one side become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
