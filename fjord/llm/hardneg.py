"""Hard negatives by angular triangle filtering.

An anchor's positives are its nearest rows of the same label; a hard negative of
a positive is a row of another label whose score lies in a window below the
positive's. Vectors are scaled to whole numbers, a score is their exact integer
inner product.

*Stored angles.* Every row stores its norm and its angles to a few reference
directions. For an anchor a and a row x the triangle inequality on the sphere
gives, for every reference r,

    |a_r - x_r|  <=  angle(a, x)  <=  min(a_r + x_r, 2 pi - (a_r + x_r))

so the cosine lies in an interval. Times both norms, and widened by what the
roundings of angles and products can amount to, it bounds the integer score.
Bounds are first taken of a tile of rows (ranges of its angles and norms) and
then of single pairs.

*Windows.* A pair is scored only where its bounds overlap the anchor's live
window: for positives, from the k-th best score so far upwards; for negatives,
the windows of the anchor's positives, each cut at its k-th best score so far.
The bounds only ever skip pairs that cannot be in the result, so the result is
exact whatever the references are. They come from a bounded sample
(``SAMPLE`` rows in order of a hash, farthest-first); on data without clusters
the angles tell little and most pairs are scored.

*Grid.* Anchors are dealt over blocks and rows over stripes by a hash of the
row; a cell of the grid holds one block and streams one stripe, sorted by
nearest reference and angle so that tiles are narrow. No cell depends on a label
or an id, so none is hot. A cell returns k rows per anchor (and positive) at
most; a window takes the k best over cells.

Defined cases: rows with a null id or label, and vectors that are null, empty or
hold a null, non-finite or (scaled) inexact component take no part, nor do those
whose norm is 2^31 or more, whose scores might not fit 64 bits; vectors are only
compared with those of the same length; a zero vector scores 0; a row is not its
own positive, but another row with its id can be; repeated rows are rows of
their own, as anchors too; an anchor without positives has no negatives; ties go
to the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjord.llm.common import ship, stage
from fjord.llm.vectors import matrix, usable, whole

SAMPLE, REFERENCES = 2048, 8
TILE, ANCHOR_TILE = 2048, 512
DENSE = 0.05  # from this share of surviving pairs on, a tile is multiplied whole
CELL_BYTES = 64 << 20
ROUNDING = 4e-7  # an angle from arccos is right to 1e-7; two of them, on either side
NEVER = np.iinfo(np.int64).min


def directions(vectors: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """Up to n unit vectors from the rows: the mean's direction, then always the one farthest from those taken."""
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.eye(1, vectors.shape[1])
    mean = unit.mean(axis=0)
    size = np.linalg.norm(mean)
    taken = [mean / size if size > 0 else unit[0]]
    nearest = unit @ taken[0]
    while len(taken) < n and nearest.min() < 1 - 1e-9:
        taken.append(unit[nearest.argmin()])
        nearest = np.maximum(nearest, unit @ taken[-1])
    return np.array(taken)


def angles(vectors: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    cosine = (vectors @ refs.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def tile_bounds(anchor: Rows, low: np.ndarray, high: np.ndarray, least: float, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of an anchor's scores with any row whose angles and norm lie in the ranges."""
    first, last = anchor.angles + low, anchor.angles + high
    far = np.maximum(np.minimum(first, 2 * np.pi - first), np.minimum(last, 2 * np.pi - last))
    far = np.where((first <= np.pi) & (last >= np.pi), np.pi, far)
    near = np.maximum(0, np.maximum(low - anchor.angles, anchor.angles - high)).max(axis=1)
    upper, lower = np.cos(near) + ROUNDING, np.cos(far.min(axis=1)) - ROUNDING
    upper, lower = upper * np.where(upper > 0, most, least), lower * np.where(lower > 0, least, most)
    return widen(lower * anchor.norms, upper * anchor.norms)


def pair_bounds(anchor: Rows, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (lower, upper) of the scores of all pairs, by the addition theorem from stored angles."""
    upper = np.full((len(anchor.norms), len(rows.norms)), np.inf)
    lower = -upper
    for r in range(anchor.angles.shape[1]):
        cos = np.cos(anchor.angles[:, r, None]) * np.cos(rows.angles[None, :, r])
        sin = np.sin(anchor.angles[:, r, None]) * np.sin(rows.angles[None, :, r])
        np.minimum(upper, cos + sin, out=upper)
        np.maximum(lower, cos - sin, out=lower)
    norms = anchor.norms[:, None] * rows.norms[None, :]
    return widen((lower - ROUNDING) * norms, (upper + ROUNDING) * norms)


def widen(lower: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outward by the relative rounding of the norms and the product."""
    slack = 1e-12 * np.maximum(np.abs(lower), np.abs(upper)) + 1e-9
    return lower - slack, upper + slack


class Rows:
    """Vectors with what is stored of them."""

    def __init__(self, u: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, norms: np.ndarray,
                 angles: np.ndarray):
        self.u, self.ids, self.labels, self.vectors, self.norms, self.angles = u, ids, labels, vectors, norms, angles

    @classmethod
    def of(cls, t: pa.Table) -> Rows:
        col = lambda c: t[c].to_numpy()
        return cls(col("u"), col("id"), t["label"].to_numpy(zero_copy_only=False), matrix(t["x"]), col("norm"), matrix(t["angles"]))

    def take(self, at: np.ndarray | slice) -> Rows:
        return Rows(self.u[at], self.ids[at], self.labels[at], self.vectors[at], self.norms[at], self.angles[at])


def scores(a: Rows, b: Rows, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the pairs (q, c)."""
    if not len(q):
        return np.empty(0, np.int64)
    if a.norms.max() * b.norms.max() < 1 << 52 and len(q) > DENSE * len(a.u) * len(b.u):
        # no partial sum exceeds the product of the norms, so doubles hold the integers
        return (a.vectors.astype(np.float64) @ b.vectors.astype(np.float64).T)[q, c].astype(np.int64)
    out, step = np.empty(len(q), np.int64), 1 << 16
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        out[part] = np.einsum("ij,ij->i", a.vectors[q[part]], b.vectors[c[part]])
    return out


class Best:
    """The k best (score, id, row) of each of n slots: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.slot = self.score = self.ids = self.u = np.empty(0, np.int64)
        self.least = np.full(n, NEVER)  # score of a full slot's last row

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, u: np.ndarray) -> None:
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        ids, u = np.concatenate([self.ids, ids]), np.concatenate([self.u, u])
        order = np.lexsort((u, ids, -score, slot))
        first = np.searchsorted(slot[order], slot[order])  # where the slot begins
        rank = np.arange(len(order)) - first
        kept = order[rank < self.k]
        self.slot, self.score, self.ids, self.u = slot[kept], score[kept], ids[kept], u[kept]
        last = order[rank == self.k - 1]
        self.least[slot[last]] = score[last]


class Positives:
    """Some anchors of a cell in the first pass: the k best rows of the anchor's own label."""

    def __init__(self, t: pa.Table, k: int):
        self.anchors, self.best = Rows.of(t), Best(len(t), k)

    def live(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= self.best.least.astype(np.float64).reshape(-1, *[1] * (upper.ndim - 1))

    def pairs(self, rows: Rows) -> np.ndarray:
        return (self.anchors.labels[:, None] == rows.labels[None, :]) & (self.anchors.u[:, None] != rows.u[None, :])

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, u: np.ndarray) -> None:
        self.best.add(q, score, ids, u)

    def result(self) -> dict[str, np.ndarray]:
        b = self.best
        return {"au": self.anchors.u[b.slot], "anchor_id": self.anchors.ids[b.slot], "place": np.zeros(len(b.slot), np.int64),
                "id": b.ids, "score": b.score, "u": b.u}


class Negatives:
    """Some anchors of a cell in the second pass: the k best rows of other labels in the window of each positive."""

    def __init__(self, t: pa.Table, k: int):
        self.anchors = Rows.of(t)
        low, high = (t[c].combine_chunks() for c in ("low", "high"))
        sizes = low.value_lengths().to_numpy()
        self.most = int(sizes.max())
        at = np.arange(len(low)).repeat(sizes), np.arange(sizes.sum()) - (np.cumsum(sizes) - sizes).repeat(sizes)
        self.low, self.high = np.full((len(low), self.most), 0), np.full((len(low), self.most), -1)  # empty where there is none
        self.low[at], self.high[at] = low.flatten().to_numpy(), high.flatten().to_numpy()
        self.best = Best(len(low) * self.most, k)

    def live(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        shape = (-1, *[1] * (upper.ndim - 1))
        least = np.maximum(self.low, self.best.least.reshape(-1, self.most)).astype(np.float64)
        high, some = self.high.astype(np.float64), self.low <= self.high
        out = np.zeros(upper.shape, bool)
        for i in range(self.most):
            out |= some[:, i].reshape(shape) & (upper >= least[:, i].reshape(shape)) & (lower <= high[:, i].reshape(shape))
        return out

    def pairs(self, rows: Rows) -> np.ndarray:
        return self.anchors.labels[:, None] != rows.labels[None, :]

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, u: np.ndarray) -> None:
        found = []
        for i in range(self.most):
            slot = q * self.most + i
            fits = np.flatnonzero((score >= np.maximum(self.low[q, i], self.best.least[slot])) & (score <= self.high[q, i]))
            found.append((slot[fits], fits))
        slot, at = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(at):
            self.best.add(slot, score[at], ids[at], u[at])

    def result(self) -> dict[str, np.ndarray]:
        b = self.best
        at = b.slot // self.most
        return {"au": self.anchors.u[at], "anchor_id": self.anchors.ids[at], "place": b.slot % self.most,
                "id": b.ids, "score": b.score, "u": b.u}


def meet(some: Positives | Negatives, rows: Rows) -> int:
    """Anchors against one tile of rows; returns the number of pairs that needed scoring."""
    a = some.anchors
    ranges = rows.angles.min(axis=0), rows.angles.max(axis=0), rows.norms.min(), rows.norms.max()
    if not some.live(*tile_bounds(a, *ranges)).any():
        return 0
    q, c = np.nonzero(some.live(*pair_bounds(a, rows)) & some.pairs(rows))
    if len(q):
        some.add(q, scores(a, rows, q, c), rows.ids[c], rows.u[c])
    return len(q)


FOUND = "au long, anchor_id long, place long, id long, score long, u long"


def cells(kind: Callable, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task of the grid: rows come sorted by cell, a cell's anchors before its stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, asked, ready, waiting = None, [], [], []

        def tiles(least: int) -> None:
            nonlocal waiting
            if ready and sum(map(len, waiting)) >= least:
                t, waiting = pa.concat_tables(waiting), []
                for at in range(0, len(t), TILE):
                    rows = Rows.of(t.slice(at, TILE))
                    for some in ready:
                        meet(some, rows)

        def finish() -> Iterator[pa.RecordBatch]:
            tiles(1)
            for some in ready:
                out = some.result()
                if len(out["u"]):
                    yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})

        for b in batches:
            t = pa.Table.from_batches([b])
            key, side = t["cell"].to_numpy(), t["side"].to_numpy()
            edge = (np.flatnonzero((np.diff(key) != 0) | (np.diff(side) != 0)) + 1).tolist()
            for a, z in zip([0, *edge], [*edge, len(t)], strict=True):
                if key[a] != current:
                    yield from finish()
                    current, asked, ready, waiting = key[a], [], [], []
                part = t.slice(a, z - a)
                if side[a] == 0:
                    asked.append(part)
                    continue
                if asked:
                    everything, asked = pa.concat_tables(asked), []
                    ready = [kind(everything.slice(i, ANCHOR_TILE), k) for i in range(0, len(everything), ANCHOR_TILE)]
                if ready:
                    waiting.append(part)
                    tiles(TILE)
        yield from finish()

    return run


def grid(anchors: DataFrame, rows: DataFrame, kind: Callable, k: int, n_anchors: int, n_rows: int, size: int,
         block_rows: int | None, stripe_rows: int) -> DataFrame:
    """Every anchor against every row, each pair in one cell: FOUND, the k best per anchor and place and cell."""
    spark = rows.sparkSession
    per_block = block_rows or max(1, CELL_BYTES // (8 * (size + 16)))
    blocks = max(1, math.ceil(n_anchors / per_block))
    wanted = math.ceil(2 * spark.sparkContext.defaultParallelism / blocks)
    stripes = max(math.ceil(n_rows / stripe_rows), min(wanted, math.ceil(n_rows / TILE)), 1)
    dealt = lambda n: F.pmod(F.xxhash64("u"), F.lit(n))
    cell = lambda g, s: F.size("x").cast("long") * (1 << 42) + g * (1 << 21) + s
    asked = (anchors.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
             .withColumn("cell", cell(dealt(blocks), F.col("s"))).drop("s"))
    streamed = (rows.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
                .withColumn("cell", cell(F.col("g"), dealt(stripes))).drop("g"))
    both = asked.withColumn("side", F.lit(0)).unionByName(streamed.withColumn("side", F.lit(1)), allowMissingColumns=True)
    return (both.repartition(blocks * stripes, "cell").sortWithinPartitions("cell", "side", "nearest", "near")
            .mapInArrow(cells(kind, k), FOUND))


def prepared(vectors: DataFrame) -> DataFrame:
    """Staged rows (u, id, label, x, norm, angles, nearest reference and the angle to it) of (id, label, v)."""
    good = vectors.filter(usable(F.col("v")) & F.col("id").isNotNull() & F.col("label").isNotNull()).select(
        "id", "label", whole(F.col("v")).alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = stage(good.select(F.monotonically_increasing_id().alias("u"), "*", norm.alias("norm"))
                 .filter(F.col("norm") < float(1 << 31)))
    sample = [r.x for r in rows.orderBy(F.xxhash64("id", "x"), "u").limit(SAMPLE).select("x").collect()]
    refs = {d: directions(np.array([x for x in sample if len(x) == d], np.float64)) for d in set(map(len, sample))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column("x").value_lengths().to_numpy()
            for d in np.unique(size):  # rows of one length together
                part = b.take(pa.array(np.flatnonzero(size == d)))
                found = angles(matrix(part.column("x")).astype(np.float64), part.column("norm").to_numpy(),
                               refs.get(int(d), np.eye(1, d)))
                edges = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(edges, found.ravel()),
                     pa.array(found.argmin(axis=1), pa.int32()), pa.array(found.min(axis=1), pa.float64())],
                    names=[*part.schema.names, "angles", "nearest", "near"])

    schema = f"u long, id long, label {rows.schema['label'].dataType.simpleString()}, x array<long>, norm double"
    return stage(rows.mapInArrow(run, schema + ", angles array<double>, nearest int, near double"))


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         block_rows: int | None = None, stripe_rows: int = 1_000_000) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` and ``label`` are expressions over ``id`` and ``label`` (the id
    and label of a row). A negative's score n fits a positive's p when
    ``low * p <= 100 * n <= high * p``.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
                          F.col(f"`{vec_col}`").alias("v"))
    rows = prepared(rows if label is None else rows.withColumn("label", label))
    is_anchor = F.coalesce(is_anchor, F.lit(False))
    n = rows.agg(F.count("*").alias("rows"), F.sum(is_anchor.cast("long")).alias("anchors"), F.max(F.size("x")).alias("size")).first()
    shape = (n.anchors or 0, n.rows, n.size or 1, block_rows, stripe_rows)
    anchors = rows.filter(is_anchor)

    best = Window.partitionBy("au").orderBy(F.desc("score"), "id", "u")
    first = (grid(anchors, rows, Positives, positives, *shape)
             .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives))
    chosen = stage(first.groupBy(F.col("au").alias("u")).agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("id").alias("positive_id"), "score"))).alias("chosen")))
    limits = lambda share, up: F.transform("chosen", lambda c: _share(c["score"], share, up))
    asked = anchors.join(chosen, "u").withColumns({"low": limits(low, True), "high": limits(high, False)})
    place = Window.partitionBy("au", "place").orderBy(F.desc("score"), "id", "u")
    found = (grid(asked.drop("chosen"), rows, Negatives, negatives, *shape)
             .withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= negatives))
    mate = F.col("chosen")[F.col("place").cast("int")]
    return found.join(chosen.withColumnRenamed("u", "au"), "au").select(
        "anchor_id", mate["positive_id"].alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        mate["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def _share(score: Column, percent: int, up: bool) -> Column:
    """The smallest (largest) whole number n with 100 * n >= (<=) percent * score, in decimals: exact for 64 bits."""
    exact = score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(10,0)") / F.lit(100).cast("decimal(10,0)")
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")
