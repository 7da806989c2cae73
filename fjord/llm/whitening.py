"""Embedding whitening by a Jacobi-Davidson eigensolver over distributed products.

Vectors become whole numbers; the covariance is that of the fit list, every
distinct vector once, and is never formed. The solver only asks for products of
the covariance with a block of vectors: each is one Spark job, in which a task
centres its rows, multiplies twice and sends one sum, and the sums meet in a
grouped aggregate of (dimension x block) rows.

The driver holds a basis of at most ``BASIS`` vectors of the dimension's length,
whatever the number of rows:

* Rayleigh-Ritz on the basis gives the wanted pairs and their residuals;
* pairs whose residual has reached double precision are locked: they stay in
  the basis and are projected out of the corrections, but get none themselves;
* every other pair gets a correction: the projected equation
  (I - UU')(A - theta I)(I - UU') t = -r is solved by a few MINRES steps, all
  open pairs sharing the distributed products;
* the corrections are made orthogonal to the basis and join it; a full basis
  starts again from its best Ritz vectors.

It ends when all wanted pairs are locked. A residual that stands still within a
hundred times the tolerance is logged and taken, any other raises.

Defined cases: vectors that are null, empty or hold a null, non-finite or
(scaled) inexact component take no part, nor do those of another length than
the commonest (of equally common ones the longest); components without variance
have no whitened values and are left out, so one distinct vector or an empty
table gives no rows; null and repeated ids each get their own rows; a deviation
that does not fit 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import ship, stage
from fjord.llm.vectors import matrix, usable, whole

START, BASIS, KEPT, INNER, MOST_ROUNDS = 8, 40, 16, 4, 200
EPS = np.finfo(float).eps
Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Whitening:
    """What a fit leaves: n fit vectors, their exact sums, unit eigenvectors (columns) by falling eigenvalue, and more."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0
    products: int = 0

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean()) @ self.vectors) / np.sqrt(self.values)


def minres(apply: Product, shifts: np.ndarray, known: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Columns t of least residual in ``steps`` Lanczos steps of P (A - shift) P t = rhs, P projecting ``known`` out.

    Column by column, but all columns share one product a step.
    """
    project = lambda x: x - known @ (known.T @ x)
    size = lambda x: np.where((s := np.linalg.norm(x, axis=0)) > 0, s, 1)
    rhs = project(rhs)
    basis, images = [rhs / size(rhs)], []
    for _ in range(steps):
        image = project(apply(basis[-1]) - basis[-1] * shifts)
        images.append(image)
        new = image.copy()
        for _ in range(2):
            for b in basis:
                new -= b * (b * new).sum(axis=0)
        left = np.linalg.norm(new, axis=0)
        basis.append(np.where(left > 1e-12 * size(image), new / size(new), 0))
    out = np.zeros_like(rhs)
    for c in range(rhs.shape[1]):
        weights = np.linalg.lstsq(np.stack([i[:, c] for i in images], axis=1), rhs[:, c], rcond=None)[0]
        out[:, c] = np.stack([b[:, c] for b in basis[:-1]], axis=1) @ weights
    return out


def fresh(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``basis``."""
    for _ in range(3):
        block = block - basis @ (basis.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 1e-200]
        if not block.shape[1]:
            return block
        u, s, _ = np.linalg.svd(block / np.linalg.norm(block, axis=0), full_matrices=False)
        block = u[:, s > 1e-8 * s[0]]
    return block[:, : len(basis) - basis.shape[1]]


def eigenpairs(apply: Product, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors as columns) of the ``wanted`` largest eigenvalues of a symmetric product."""
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.normal(size=(size, min(size, max(START, 2 * wanted)))))[0]
    images = apply(basis)
    tolerance, best, stuck = max(size, 64) * EPS, np.inf, 0
    most, kept = max(BASIS, 6 * wanted), max(KEPT, 3 * wanted)
    for _ in range(MOST_ROUNDS):
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        residuals = images - basis * values
        off = np.linalg.norm(residuals, axis=0)[:wanted] / max(values[0], np.finfo(float).tiny)
        open_ = np.flatnonzero(off > tolerance)
        if not len(open_):
            return values[:wanted], basis[:, :wanted]
        stuck = 0 if off.max() < 0.5 * best else stuck + 1
        best = min(best, off.max())
        if off.max() < 100 * tolerance and stuck >= 5:
            logging.getLogger(__name__).warning("residuals stand still at %g", off.max())
            return values[:wanted], basis[:, :wanted]
        if basis.shape[1] + len(open_) > most:
            basis, images = basis[:, :kept], images[:, :kept]
        known = basis[:, :wanted]
        block = fresh(minres(apply, values[open_], known, -residuals[:, open_], INNER), basis)
        if not block.shape[1]:  # nothing new: the residuals themselves, then any direction
            block = fresh(np.hstack([residuals[:, open_], rng.normal(size=(size, 2))]), basis)
        if block.shape[1]:
            basis, images = np.hstack([basis, block]), np.hstack([images, apply(block)])
    raise RuntimeError(f"residuals have not settled after {MOST_ROUNDS} rounds: {off.max()}")


def summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``of(matrix of some rows)``: one partial sum a task, added up in Spark by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = of(matrix(b.column("x")))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"y": pa.array([total.tolist()], pa.list_(pa.float64()))})

    parts = rows.select("x").mapInArrow(run, "y array<double>").select(F.posexplode("y"))
    found = {r.pos: r.total for r in parts.groupBy("pos").agg(F.sum("col").alias("total")).collect()}
    return np.array([found[i] for i in range(len(found))])


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (id, x) that take part: whole-number vectors of the commonest length."""
    v = F.col(f"`{vec_col}`")
    good = vectors.filter(usable(v)).select(F.col(f"`{id_col}`").alias("id"), whole(v).alias("x"))
    lengths = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.filter(F.size("x") == (lengths.d if lengths else 0))


def fit(rows: DataFrame, components: int = 4) -> Whitening | None:
    """Mean and leading eigenvectors of the distinct vectors in ``rows`` (x); None where they do not vary."""
    distinct = stage(rows.select("x").distinct())
    half = 26  # sums of high and low parts stay exact in 64 bits
    sums = (distinct.select(F.posexplode("x")).groupBy("pos").agg(
        F.count("*").alias("n"), F.sum(F.shiftright("col", half)).alias("high"),
        F.sum(F.col("col").bitwiseAND((1 << half) - 1)).alias("low")).orderBy("pos").collect())
    if not sums:
        return None
    n, totals = sums[0].n, [(r.high << half) + r.low for r in sums]
    mean = np.array([s / n for s in totals])
    trace = float(summed(distinct, lambda x: ((x - mean) ** 2).sum(axis=0)).sum()) / n
    if n < 2 or trace == 0:
        return None
    asked = 0

    def apply(block: np.ndarray) -> np.ndarray:
        nonlocal asked
        asked += 1

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return (centred.T @ (centred @ block)).ravel()

        return summed(distinct, part).reshape(block.shape) / n

    values, found = eigenpairs(apply, len(mean), min(components, len(mean)))
    telling = values > max(len(mean), 64) * EPS * values[0]
    found = found[:, telling] * np.where(found[np.abs(found).argmax(axis=0), range(found.shape[1])] < 0, -1, 1)[telling]
    model = Whitening(n, totals, found, values[telling], trace, products=asked)

    def moments(x: np.ndarray) -> np.ndarray:
        z = model.project(x)
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    k = len(model.values)
    total = summed(distinct, moments) / n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exactly; None beyond 64 bits."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if x.shape[1] * reach * reach < 1 << 62:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = (((x.astype(object) * n) - np.array(sums, object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error."""
    ship(vectors.sparkSession)
    rows = scaled(vectors, id_col, vec_col)
    model = fit(rows, components)
    kind = f"`{id_col}` {rows.schema['id'].dataType.simpleString()}"
    schema = f"{kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                b.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(x) * k, model.n), pa.int64()), pa.array(deviations(x, model.n, model.sums), pa.int64()).take(each),
                pa.array(model.project(x).ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(x) * k, model.identity_error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
