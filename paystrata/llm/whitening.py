"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries c become whole numbers ``x = floor(256 * c)``; each distinct vector x counts once (the fit list). Its covariance V (divisor
n) is never formed: a pass over the fit list takes a block Q of a few columns to ``V Q``, each task its own part of
``sum (x - mean) ((x - mean)' Q)``, centred before multiplying.

An iteration applies a Chebyshev polynomial of V to the block, one pass a degree: it stays small on [0, b], the spectrum that is not
wanted, and grows steeply beyond b, which is the block's smallest Ritz value. QR and Rayleigh-Ritz (one more pass) then give the best
eigenvalues and vectors in the block. That goes on until the residuals ``|V q - e q|`` of the wanted components are down to rounding:
then a vector is off its eigenvector by at most the residual over the gap to the other eigenvalues. If rounding keeps them higher, it
goes on while an iteration still halves them.

What comes to the driver is of the size of a block. ``S`` and deviations are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.llm.common import ship, stored

SCALE = 256
COMPONENTS = 4
#: Columns of the block beyond the wanted ones, degree of a polynomial, and iterations after which it is an error not to be done.
MORE_COLUMNS = 12
DEGREE = 10
MOST_ITERATIONS = 100
#: A residual that is rounding, and one that must be reached, as parts of the largest eigenvalue.
ROUNDING = 2e-15
CERTIFIED = 1e-9
#: An eigenvalue below this part of the trace is none.
NO_VARIANCE = 1e-12

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])


@dataclass
class Whitening:
    n: int
    sums: list[int]
    vectors: np.ndarray         # a column to each component
    values: np.ndarray          # the eigenvalues of V
    trace: float
    residual: float
    iterations: int
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], float)


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the vectors that count: those without null or non-finite entries, of the commonest length."""
    doubled = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0 ** 62 / SCALE))
    good = (rows.select(F.col(id_col).cast("long").alias("vec_id"), doubled.alias("v"))
            .filter(F.col("v").isNotNull() & F.coalesce(F.forall("v", whole), F.lit(False)) & (F.size("v") > 0)))
    lengths = good.groupBy(F.size("v").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).select("d").collect()
    size = common[0]["d"] if common else 0
    return good.filter(F.size("v") == size).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def _matrix(batch, at: int) -> np.ndarray:
    column = batch.column(at)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(fit: DataFrame, part) -> np.ndarray:
    """The sum of ``part`` (a matrix of whole numbers -> a flat array of doubles) over all rows; added up outside the driver."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(_matrix(batch, 0))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.float64())],
                                             names=["k", "v"])

    rows = fit.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: r["k"])])


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch, 0) if batch.num_rows else np.zeros((0, 0), np.int64)
            d = x.shape[1]
            # two halves, so that no sum of a batch overflows
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array((x >> 32).sum(axis=0)), pa.array((x & 0xFFFFFFFF).sum(axis=0)),
                 pa.array(np.full(d, len(x), np.int64))], names=["k", "high", "low", "n"])

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = (fit.select("x").mapInArrow(run, "k int, high long, low long, n long").groupBy("k")
            .agg(total("high"), total("low"), total("n")).orderBy("k").collect())
    return (int(rows[0]["n"]) if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def principal(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The first components of the fit list (a column x), by falling eigenvalue."""
    n, sums = exact_sums(fit)
    d = len(sums)
    if not d:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, 0)
    mean = np.array([s / n for s in sums], float)
    wanted, width = min(components, d), min(d, components + MORE_COLUMNS)
    passes = 0

    def product(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x):
            centred = x - mean
            return (centred.T @ (centred @ block)).reshape(-1)

        return _summed(fit, part).reshape(d, block.shape[1]) / n

    trace = float(_summed(fit, lambda x: np.array([((x - mean) ** 2).sum()]))[0]) / n
    block = np.linalg.qr(np.random.default_rng(20250612).standard_normal((d, width)))[0]
    best = np.inf
    for iteration in range(MOST_ITERATIONS):
        image = product(block)
        inner = block.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(image - block * values, axis=0)[:wanted].max())
        if residual <= ROUNDING * top or residual <= CERTIFIED * top and residual > best / 2:
            return Whitening(n, sums, block[:, :wanted], np.maximum(values[:wanted], 0), trace, residual, iteration + 1)
        best = min(best, residual)
        block = np.linalg.qr(_filtered(product, block, image, top, max(float(values[-1]), 0.0)))[0]
    raise RuntimeError(f"residual {residual} of the eigenvectors after {passes} passes")


def _filtered(product, block: np.ndarray, image: np.ndarray, top: float, bound: float) -> np.ndarray:
    """The block under a Chebyshev polynomial of V that is at most 1 on [0, bound], scaled by its value at the top."""
    if bound <= 1e-14 * top:                # the block reaches past the spectrum: a plain power keeps what there is
        return image / top
    half = bound / 2
    sigma = first = half / (top - half)
    before, now = block, (image - half * block) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (product(now) - half * now) * (2 * following / half) - (sigma * following) * before
        sigma = following
    return now


def _steps(model: Whitening) -> np.ndarray:
    """What takes a centred vector to its whitened components; NaN for a component without variance."""
    real = model.values > NO_VARIANCE * model.trace
    return model.vectors / np.sqrt(np.where(real, model.values, np.nan))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened fit list, less the identity; of components with variance."""
    steps, mean = _steps(model), model.mean
    steps = steps[:, np.isfinite(steps).all(axis=0)]
    k = steps.shape[1]
    if not k:
        return 0.0

    def part(x):
        white = (x - mean) @ steps
        return np.concatenate([white.sum(axis=0), (white.T @ white).reshape(-1)])

    total = _summed(fit, part) / model.n
    return float(np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """For each row the sum of ``(n * x - S)**2``, exact; null where it is no long."""
    mean = np.array([s / n for s in sums], float)
    rough = (((x - mean) * n) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):        # exact modulo 2**64, so exact where the sum is known to fit
        own = x.astype(np.uint64) * np.uint64(n % 2 ** 64) - np.array([s % 2 ** 64 for s in sums], np.uint64)
        out = (own * own).sum(axis=1, dtype=np.uint64).view(np.int64)
    fits = rough < 2.0 ** 63 * (1 - 1e-6)
    for i in np.flatnonzero(~fits & (rough < 2.0 ** 63 * (1 + 1e-6))).tolist():
        fits[i] = sum((n * int(v) - s) ** 2 for v, s in zip(x[i].tolist(), sums)) < 2 ** 63
    return pa.array(out, pa.int64(), mask=~fits)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, hold null or non-finite entries or entries from 2**54 on, or have another length than most
    vectors (of two as common lengths the larger counts) are left out. Repeated vectors count once in the fit and have their rows
    each; null ids are kept. Vectors of fewer dimensions than ``components`` have that many components. A component without
    variance (equal vectors, dependent dimensions) has a null ``whitened``. A ``deviation`` beyond a long is null. Other columns
    are ignored. An empty table gives no rows.
    """
    ship(rows.sparkSession)
    vectors = stored(whole_vectors(rows, id_col, vector_col), "whitening-vectors")
    fit = stored(vectors.select("x").distinct(), "whitening-fit")
    model = principal(fit, components)
    if model.n:
        model.identity_error = identity_error(fit, model)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        if not own.n:
            return
        steps, mean, k = _steps(own), own.mean, len(own.values)
        explained = own.values / own.trace if own.trace else np.zeros(k)
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            x = _matrix(batch, 1)
            white = np.einsum("nd,dk->nk", x - mean, steps).reshape(-1)
            each = pa.array(np.repeat(np.arange(count), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                 pa.array(np.full(count * k, own.n, np.int64)), deviations(x, own.n, own.sums).take(each),
                 pa.array(white, pa.float64(), mask=np.isnan(white)), pa.array(np.tile(explained, count)),
                 pa.array(np.full(count * k, own.identity_error))], names=SCHEMA.names)

    return vectors.mapInArrow(run, SCHEMA)
