"""Nearest neighbours by a block matrix join with int8 products and error bounds.

Queries and candidates are dealt over a grid of cells: every cell holds one
block of queries and one stripe of candidates, and each pair of vectors meets
in exactly one cell. A cell streams its candidates in tiles. Vectors are scaled
to int8; the product of two tiles gives every inner product within

    |x'| |ey| + |ex| |y'| + |ex| |ey|      (x' the scaled vector, ex = x - x')

Pairs whose upper bound stays below the k-th best lower bound, or below the
k-th exact score so far, cannot be among the k nearest. Survivors are computed
again in double precision on the original vectors and merged by a heap per
query. The search is exact: the bounds never drop a true neighbour. Each cell
returns k rows per query at most, and a window takes the k best over cells.

Communication is N*Q*d / (block rows) + N*Q*d / (stripe rows); both sides of a
cell are bounded, and candidates are streamed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjord.llm.common import ship

TILE, QUERY_TILE = 4096, 512
BLOCK_BYTES = 32 << 20  # of a block of queries, in doubles; a cell holds about twice that
SLACK = 1e-9  # relative: rounding of the bound's own arithmetic, in doubles


class Cell:
    """Queries of one cell and the heap of the best candidates of each."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.keys, self.vectors, self.k = ids, keys, vectors, k
        self.ints, self.scale, self.err, self.norm = quantise(vectors)
        self.best: list[list[tuple[float, int]]] = [[] for _ in ids]

    def add(self, ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray) -> None:
        """Merge a tile of candidates into the heaps."""
        ints, scale, err, norm = quantise(vectors)
        for at in range(0, len(self.ids), QUERY_TILE):
            part = slice(at, at + QUERY_TILE)
            # whole numbers below 2^24 (2^53 when long) are exact in floating point, so this is the int8 product
            near = (self.ints[part] @ ints.T).astype(np.float64) * self.scale[part, None] * scale[None, :]
            bound = self.norm[part, None] * err + self.err[part, None] * (norm + err)
            bound += SLACK * (self.norm[part, None] + self.err[part, None]) * (norm + err) + np.finfo(float).tiny
            near[(self.ids[part, None] == ids[None, :]) & (self.keys[part, None] == keys[None, :])] = -np.inf
            least = np.array([-b[-1][0] if len(b) == self.k else -np.inf for b in self.best[part]])
            if len(ids) > self.k:
                least = np.maximum(least, np.partition(near - bound, -self.k, axis=1)[:, -self.k])
            q, c = np.nonzero((near + bound >= least[:, None]) & (near > -np.inf))
            if not len(q):
                continue
            exact = dot(self.vectors[at + q], vectors[c])
            edges = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1], [True])))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                row = at + q[a]
                found = zip((-exact[a:b]).tolist(), ids[c[a:b]].tolist(), strict=True)
                self.best[row] = heapq.nsmallest(self.k, [*self.best[row], *found])

    def result(self) -> pd.DataFrame:
        n = [len(b) for b in self.best]
        flat = [x for b in self.best for x in b]
        return pd.DataFrame({"query_id": np.repeat(self.ids, n), "query_key": np.repeat(self.keys, n),
                             "vec_id": np.array([i for _, i in flat], np.int64),
                             "score": np.array([0.0 - s for s, _ in flat], np.float64)})


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(whole numbers -127..127, scale, norm of the error, norm of the scaled vector) of each row."""
    scale = np.abs(v).max(axis=1) / 127
    whole = np.rint(v / scale[:, None])
    approx = whole * scale[:, None]
    exact_in = np.float32 if v.shape[1] <= 1000 else np.float64
    return whole.astype(exact_in), scale, np.linalg.norm(v - approx, axis=1), np.linalg.norm(approx, axis=1)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def valid(vec: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           query_rows: int | None = None, stripe_rows: int = 4_000_000) -> DataFrame:
    """The k rows with the largest inner product of every query row: query_id, rank, vec_id, score.

    Defined cases: rows with a null id, and vectors that are null, empty, zero
    or hold a null, NaN or infinite component take no part; vectors are only
    compared with those of the same length; candidates are all rows but the
    query's own; ties go to the smaller id; repeated query rows (same id and
    vector) are one row, searched once and not a neighbour of itself, rows that
    share an id but not the vector each get their own ranks and can be each
    other's neighbours; repeated candidate rows each count; an empty table
    gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    good = vectors.filter(valid(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"),  # as stored: a task widens its own rows
        F.xxhash64(vec_col).alias("key"), F.coalesce(is_query, F.lit(False)).alias("q"))
    counts = good.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0)), F.max(F.size("v"))).first()
    query_rows = query_rows or max(1, BLOCK_BYTES // (8 * (counts[2] or 1)))
    blocks = max(1, math.ceil(counts[1] / query_rows))
    wanted = math.ceil(2 * spark.sparkContext.defaultParallelism / blocks)
    stripes = max(math.ceil(counts[0] / stripe_rows), min(wanted, math.ceil(counts[0] / TILE)), 1)

    row = F.xxhash64("id", "key")
    cell = lambda g, s: F.size("v").cast("long") * (1 << 42) + g * (1 << 21) + s
    queries = (good.filter("q").select("id", "key", "v", F.lit(0).alias("side")).distinct()
               .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
               .withColumn("cell", cell(F.pmod(row, F.lit(blocks)), F.col("s"))).drop("s"))
    candidates = (good.select("id", "key", "v", F.lit(1).alias("side"))
                  .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
                  .withColumn("cell", cell(F.col("g"), F.pmod(row, F.lit(stripes)))).drop("g"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked: list[tuple] = []  # queries of a cell come before its candidates

        def start() -> Cell | None:
            if not asked:
                return None
            ids, keys, v = (np.concatenate(x) for x in zip(*asked, strict=True))
            return Cell(ids, keys, v, k)

        current, ready = None, None
        for b in batches:
            for (c, side), rows in b.groupby(["cell", "side"], sort=False):
                if c != current:
                    if ready is not None:
                        yield ready.result()
                    current, ready, asked = c, None, []
                ids, keys = rows["id"].to_numpy(), rows["key"].to_numpy()
                v = np.stack(rows["v"].to_list()).astype(np.float64)
                if side == 0:
                    asked.append((ids, keys, v))
                    continue
                ready = ready or start()
                for at in range(0, len(ids) if ready else 0, TILE):
                    ready.add(ids[at:at + TILE], keys[at:at + TILE], v[at:at + TILE])
        if ready is not None:
            yield ready.result()

    both = queries.unionByName(candidates).repartition(blocks * stripes, "cell").sortWithinPartitions("cell", "side")
    found = both.mapInPandas(run, "query_id long, query_key long, vec_id long, score double")
    w = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
