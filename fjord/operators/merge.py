"""SCD type-2 merge and keyed upsert without a MERGE-capable table format.

Parquet tables cannot ``MERGE``; the same result comes from one equi-join of
the *current* target rows with the source. Closed history rows never take
part in the join: they pass through with a union (no shuffle). Jobs write the
result to a new version directory and repoint the table (``fjord.plans.jobs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fjord.functions.exprs import ident

SCD2_SCHEMA = T.StructType([
    T.StructField("account_hash", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("valid_from", T.TimestampType()),
    T.StructField("valid_to", T.TimestampType()),
    T.StructField("is_current", T.BooleanType()),
])
OPEN_END = "9999-12-31 00:00:00"


def _ts(value) -> F.Column:
    return F.lit(str(value)).cast("timestamp") if not isinstance(value, F.Column) else value


def scd2_merge(target: DataFrame, source: DataFrame, now, mode: str = "single",
               key: str = "account_hash", value: str = "risk_score") -> DataFrame:
    """J1 / K10. ``source`` has one row per key: (key, value).

    single — exactly the reference MERGE: a current row whose value changed
    (``<>``, so NULL never counts as a change) is closed; a source key with
    no current row (NULL keys never match) is inserted. The changed key's new
    version only appears on a later run.

    complete — keys and change compared NULL-safely; a changed key is closed
    *and* its new version inserted in the same run, leaving exactly one
    current row per key.

    Plan: one full-outer equi-join (shuffle on the key) of the current rows
    with the source; history rows and, in single mode, NULL-key rows (which
    can never match) bypass the join through unions.
    """
    history = target.filter(~F.col("is_current"))
    current = target.filter(F.col("is_current"))
    return history.unionByName(_scd2_step(current, source, now, mode, key, value, keep=True))


def scd2_changes(current: DataFrame, source: DataFrame, now, mode: str = "single",
                 key: str = "account_hash", value: str = "risk_score") -> DataFrame:
    """Only what a merge of ``source`` changes: the current rows it closes, as closed, and the rows it inserts."""
    return _scd2_step(current, source, now, mode, key, value, keep=False)


def _scd2_step(current: DataFrame, source: DataFrame, now, mode: str, key: str, value: str, keep: bool) -> DataFrame:
    """Current rows after the merge, with those it closes; without ``keep`` unchanged ones are left out."""
    if mode not in ("single", "complete"):
        raise ValueError(f"unknown SCD2 mode {mode!r}")
    now = _ts(now)
    end = F.lit(OPEN_END).cast("timestamp")
    bypass = []
    if mode == "single":
        if keep:
            bypass.append(current.filter(F.col(key).isNull()))
        bypass.append(source.filter(F.col(key).isNull()).select(
            key, value, now.alias("valid_from"), end.alias("valid_to"), F.lit(True).alias("is_current")))
        current, source = current.filter(F.col(key).isNotNull()), source.filter(F.col(key).isNotNull())

    t = current.select(*[F.col(c).alias(f"t_{c}") for c in current.columns], F.lit(True).alias("__t"))
    s = source.select(F.col(key).alias("s_key"), F.col(value).alias("s_val"), F.lit(True).alias("__s"))
    if mode == "single":
        cond = F.col(f"t_{key}") == F.col("s_key")
        changed = F.coalesce(F.col(f"t_{value}") != F.col("s_val"), F.lit(False))
    else:
        cond = F.col(f"t_{key}").eqNullSafe(F.col("s_key"))
        changed = ~F.col(f"t_{value}").eqNullSafe(F.col("s_val"))
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    close = in_t & in_s & changed

    kept = F.struct(
        F.col(f"t_{key}").alias(key), F.col(f"t_{value}").alias(value), F.col("t_valid_from").alias("valid_from"),
        F.when(close, now).otherwise(F.col("t_valid_to")).alias("valid_to"),
        F.when(close, F.lit(False)).otherwise(F.col("t_is_current")).alias("is_current"))
    insert = (in_s & ~in_t) if mode == "single" else (in_s & (~in_t | changed))
    inserted = F.struct(F.col("s_key").alias(key), F.col("s_val").alias(value), now.alias("valid_from"),
                        end.alias("valid_to"), F.lit(True).alias("is_current"))
    both = F.filter(F.array(F.when(in_t if keep else close, kept), F.when(insert, inserted)), lambda r: r.isNotNull())
    out = j.select(F.inline(both))
    for extra in bypass:
        out = out.unionByName(extra)
    return out


def upsert(existing: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Insert new keys, replace rows whose key exists; one row per key afterwards.

    Of several updates of one key the greatest row (columns compared in order) wins, whatever their order;
    NULL is a key like any other.
    """
    rest = [c for c in updates.columns if c != key]
    one = updates.groupBy(key).agg(F.max(F.struct(*[F.col(ident(c)) for c in rest])).alias("__r")) \
        .select(key, *[F.col("__r")[c].alias(c) for c in rest]) if rest else updates.distinct()
    keys = one.select(F.col(key).alias("__k"))
    return existing.join(keys, existing[key].eqNullSafe(F.col("__k")), "left_anti").unionByName(one.select(*updates.columns))
