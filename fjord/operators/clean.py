"""Silver cleaning: defensive casts, good/quarantine split, dedup, rules, reconcile.

The same functions serve a batch job, a streaming ``foreachBatch`` and the
registered queries. ``as_of`` pins "today" so a replayed batch selects the
same rows and the oracle is deterministic.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjord.functions.constants import DEFAULT_REASON_RULES, QUARANTINE_RULES, SILVER_CASTS
from fjord.functions.exprs import ident

BUSINESS_KEY = ("TransactionID", "AccountID")
RESCUE = "_rescued_data"


def _as_of_col(as_of: dt.date | str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def defensive_cast(df: DataFrame, casts: dict[str, str] = SILVER_CASTS) -> DataFrame:
    """``try_cast`` the typed columns, pass every other column through."""
    return df.select(*[
        F.col(ident(c)).try_cast(casts[c]).alias(c) if c in casts else F.col(ident(c))
        for c in df.columns
    ])


def good_condition(df: DataFrame, as_of=None, strict: bool = False) -> Column:
    """P6 on raw columns: no rescue, amount > 0, date present and not in the future."""
    amount = F.col("TransactionAmount").try_cast("double")
    date = F.col("TransactionDate").try_cast("date")
    cond = amount.isNotNull() & (amount > 0) & date.isNotNull() & (date <= _as_of_col(as_of))
    if RESCUE in df.columns:
        cond = F.col(RESCUE).isNull() & cond
    if strict:
        cond = cond & ~F.isnan(amount)
    return cond


def quarantine_condition(df: DataFrame) -> Column:
    """P7 on raw columns: rescue present or a required field NULL."""
    cond = (F.col("TransactionAmount").isNull() | F.col("TransactionDate").isNull()
            | F.col("TransactionID").isNull() | F.col("AccountID").isNull())
    if RESCUE in df.columns:
        cond = F.col(RESCUE).isNotNull() | cond
    return cond


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """L1: one row per key, NULL keys grouped together (as ``dropDuplicates``).

    The survivor is the smallest row by ``order`` (default: all columns in
    order), so it is deterministic. It is an aggregate, not a window: each map
    task reduces a key to one row before the shuffle, so a key holding a third
    of the data costs one row per task rather than one giant sorted partition.
    """
    cols = list(df.columns)
    order = list(order or cols)
    rest = [c for c in cols if c not in order]
    packed = F.struct(*[F.col(ident(c)).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(ident(c)).alias(f"r{i}") for i, c in enumerate(rest)])
    best = df.groupBy(*[F.col(ident(k)).alias(k) for k in keys]).agg(F.min(packed).alias("__best"))
    return best.select(
        *[F.col(f"__best.o{order.index(c)}").alias(c) if c in order
          else F.col(f"__best.r{rest.index(c)}").alias(c) for c in cols])


def silver_good(batch: DataFrame, as_of=None, strict: bool = False,
                keys: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """P6 + P4 + L1: good rows, typed, one per business key."""
    return dedup_first(defensive_cast(batch.filter(good_condition(batch, as_of, strict))), keys)


def silver_quarantine(batch: DataFrame, as_of=None, strict: bool = False) -> DataFrame:
    """P7 (default) or, in strict mode, every row that is not good (a true partition)."""
    if strict:
        return batch.filter(~F.coalesce(good_condition(batch, as_of, True), F.lit(False)))
    return batch.filter(quarantine_condition(batch))


def reconcile(batch: DataFrame, as_of=None, keys: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """One row of totals; adds the good-and-bad / neither counts.

    One pass: per business key (NULLs as one key, like ``dropDuplicates``)
    the rows of each good/bad combination are counted — a partial aggregate,
    so a hot key is one row per task — and one global aggregate sums them;
    the distinct good keys are the keys with a good row.
    """
    g = F.coalesce(good_condition(batch, as_of), F.lit(False))
    b = F.coalesce(quarantine_condition(batch), F.lit(False))
    flags = batch.select(*[F.col(ident(k)).alias(f"__k{i}") for i, k in enumerate(keys)], g.alias("g"), b.alias("b"))
    per_key = flags.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("g")).alias("ng"),
        F.count_if(F.col("b")).alias("nb"),
        F.count_if(F.col("g") & ~F.col("b")).alias("n_good_only"),
        F.count_if(~F.col("g") & F.col("b")).alias("n_bad_only"),
        F.count_if(F.col("g") & F.col("b")).alias("n_both"),
        F.count_if(~F.col("g") & ~F.col("b")).alias("n_neither"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")  # noqa: E731 - 0 on an empty batch
    return per_key.agg(
        total("n").alias("rows_in"),
        total("ng").alias("good_rows"),
        total("nb").alias("quarantined"),
        total("n_good_only").alias("good_only"),
        total("n_bad_only").alias("bad_only"),
        total("n_both").alias("both"),
        total("n_neither").alias("neither"),
        F.count_if(F.col("ng") > 0).alias("good_after_dedup"),
    )


_CAST_RE = re.compile(r"(?<![A-Za-z_])CAST\s*\(", re.IGNORECASE)


def ansi_safe(rule: str) -> str:
    """Rules written with CAST raise under ANSI mode; use TRY_CAST."""
    return _CAST_RE.sub("TRY_CAST(", rule)


def rules_condition(rules: Sequence[str] = QUARANTINE_RULES) -> Column:
    """A row is quarantined when any rule matches (NULL counts as no match)."""
    return F.coalesce(F.expr(" OR ".join(f"({ansi_safe(r)})" for r in rules)), F.lit(False))


def quarantine_by_rules(df: DataFrame, rules: Sequence[str] = QUARANTINE_RULES) -> DataFrame:
    return df.filter(rules_condition(rules))


def quarantine_reason(rules: Sequence[str] | None = None) -> Column:
    """Text of the first matching rule, else NULL; default rules when empty."""
    rules = list(rules) if rules else list(DEFAULT_REASON_RULES)
    expr = None
    for r in rules:
        cond = F.coalesce(F.expr(ansi_safe(r)), F.lit(False))
        expr = F.when(cond, F.lit(r)) if expr is None else expr.when(cond, F.lit(r))
    return expr.otherwise(F.lit(None).cast("string"))
