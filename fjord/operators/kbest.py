"""The k best rows per query: in a task, from a stream of score tiles, and over all tasks.

A task that meets rows with a whole query batch calls :meth:`KBest.add` with one
tile (rows x queries keys, smaller is better) after the other. Only what can
still be among a query's k best leaves a tile, so the state is at most
queries x k rows, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE_ELEMENTS = 2_000_000  # rows x queries of one tile: 16 MB of doubles


def tile_rows(n_queries: int) -> int:
    """Rows of a tile that keep it within TILE_ELEMENTS."""
    return max(1, TILE_ELEMENTS // max(1, n_queries))


class KBest:
    """``frame``: columns ``__q`` (query number), ``__key`` and those of the rows; ties go to the smaller ``tie``."""

    def __init__(self, n_queries: int, k: int, tie: str):
        self.k, self.tie = k, tie
        self.worst = np.full(n_queries, np.inf)  # key of the k-th best so far
        self.frame: pd.DataFrame | None = None

    def add(self, key: np.ndarray, rows: pd.DataFrame, known: np.ndarray | None = None) -> None:
        """Meet a tile. ``key`` is infinite where there is no score; pairs outside the mask ``known`` do not count."""
        if known is not None:
            key = np.where(known, key, np.inf)
        limit = self.worst
        if len(key) > self.k:
            limit = np.minimum(limit, np.partition(key, self.k - 1, axis=0)[self.k - 1])
        fits = key <= limit
        if known is not None:
            fits &= known
        at, q = np.nonzero(fits)
        if not len(at):
            return
        found = rows.iloc[at].reset_index(drop=True)
        found.insert(0, "__q", q)
        found.insert(1, "__key", key[at, q])
        both = found if self.frame is None else pd.concat([self.frame, found], ignore_index=True)
        both = both.sort_values(["__q", "__key", self.tie], kind="mergesort")
        self.frame = both.groupby("__q", sort=False).head(self.k).reset_index(drop=True)
        full = self.frame.groupby("__q").nth(self.k - 1)
        self.worst[full["__q"].to_numpy()] = full["__key"].to_numpy()


def top_k_per_group(cands: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    buckets: int = 64) -> DataFrame:
    """Top-k rows per group (``rank`` = 1..k) without putting a whole group in one task.

    A ``row_number() <= k`` filter over a window is planned by Spark with a
    partial ``WindowGroupLimit`` before the shuffle: every map task keeps only
    its best k rows per group, so a hot group costs k rows per task, never the
    group (asserted in the plan tests). Spark inserts that limit only for k up
    to ``spark.sql.optimizer.windowGroupLimitThreshold``; above it the cut is
    taken in two steps — best k per (group, row-hash bucket), then over the at
    most k × buckets survivors — which is exact, since a global top-k row is in
    the top k of its own bucket.
    """
    group = list(group)
    limit = int(cands.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        b = cands.withColumn("__b", F.pmod(F.xxhash64(*[F.col(c) for c in cands.columns]), F.lit(buckets)))
        w1 = Window.partitionBy(*group, "__b").orderBy(*order)
        cands = b.withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k).drop("__r", "__b")
    w = Window.partitionBy(*group).orderBy(*order)
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
