"""Whole-number vectors shared by the embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256
LARGEST = 1 << 53  # whole numbers up to here are exact in double precision


def usable(vec: Column) -> Column:
    """Not null or empty, every component a finite number whose scaled value is exact."""
    bound = float(LARGEST // SCALE)
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < bound))
    return F.coalesce(fine & (F.size(vec) > 0), F.lit(False))


def whole(vec: Column) -> Column:
    """floor(256 * x) of every component, x as double."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow list column, all of one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
