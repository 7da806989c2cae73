"""Scalar column expressions shared by the operators (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pii_hash(c: Column, salt: str | None = None) -> Column:
    """SHA-256 hex of an identifier, optionally salted."""
    if salt:
        c = F.concat(F.lit(salt), c)
    return F.sha2(c, 256)


def money_text(c: Column) -> Column:
    """An amount for display: 2 decimals. Never used where a value is stored or compared."""
    return c.cast("decimal(38,2)").cast("string")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0 (nullif guard; ANSI would raise)."""
    return (num.cast("double") / F.nullif(den, F.lit(0)).cast("double")).cast("double")


def ident(name: str) -> str:
    """Back-quote a column name for use inside a SQL expression."""
    return "`" + name.replace("`", "``") + "`"
