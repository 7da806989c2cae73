"""Output normalisation shared by registered queries and their SQL oracles.

Doubles are rounded (float sums differ in the last bits with partitioning),
floats widened to double. The oracle SQL applies the same rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 6


def rounded(df: DataFrame, scale: int = SCALE) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), scale).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
