"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance of a table of vectors is never formed: all that is asked of it is its product with a few columns Q, one pass over the
table that sums Xᵀ(XQ) over blocks of centred vectors. Products are chained into a Chebyshev polynomial that is small on the spectrum that
is not wanted and grows fast above it; the filtered columns are made orthonormal (QR) and rotated into the best approximations in their span
(Rayleigh-Ritz). That is done until each wanted pair's residual is at rounding level, which certifies it. A Lanczos column that travels
in the first passes tells where the spectrum begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpack.llm.vectors import chunks, first_block, matrix, rows_a_block, usable
from docpack.session import written

TOLERANCE = 1e-13
SPREAD = 1e8  # how much more than the last wanted direction the first may grow in one filter


@dataclass
class Spectrum:
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column each
    residual: float  # the greatest of the wanted pairs, as a share of the greatest eigenvalue
    passes: int


def dominant(product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, guard: int = 16, most: int = 400, seed: int = 0) -> Spectrum:
    """The ``wanted`` largest eigenpairs of a symmetric positive semidefinite matrix of which only ``product`` is known.

    Fails if ``most`` products do not certify them: a residual of at most ``TOLERANCE`` times the greatest eigenvalue, or one that
    rounding keeps from falling further below a thousand times that.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dimension)
    width = min(dimension, wanted + guard)
    q = np.linalg.qr(rng.standard_normal((dimension, width)))[0]
    lanczos = _Lanczos(rng.standard_normal(dimension))
    passes, before = 0, np.inf

    def times(x: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        if (column := lanczos.column()) is None:
            return product(x)
        both = product(np.column_stack([x, column]))
        lanczos.take(both[:, -1])
        return both[:, :-1]

    while True:
        aq = times(q)
        small = q.T @ aq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, aq = q @ turn, aq @ turn
        top = max(float(values[0]), np.finfo(float).tiny)
        residual = float(np.linalg.norm(aq - q * values, axis=0)[:wanted].max()) / top
        if residual <= TOLERANCE or width == dimension or (residual <= 1000 * TOLERANCE and residual > before / 2):
            return Spectrum(values[:wanted], q[:, :wanted], residual, passes)
        if passes >= most:
            raise ArithmeticError(f"not certified after {passes} passes: residual {residual}")
        before = residual
        q = np.linalg.qr(_filtered(times, q, aq, values, wanted, lanczos.least(), residual))[0]


def _filtered(times: Callable, q: np.ndarray, aq: np.ndarray, values: np.ndarray, wanted: int, least: float, residual: float) -> np.ndarray:
    """``q`` under the scaled Chebyshev polynomial that is at most one on ``[least, values[-1]]``; ``aq`` is its first product."""
    high = float(values[-1])
    low = min(max(least, 0.0), high * (1 - 1e-6))
    half, middle = (high - low) / 2, (high + low) / 2
    if half <= 0:  # nothing to damp
        return aq
    grown = lambda x: np.arccosh(max((x - middle) / half, 1 + 1e-12))
    first, last = grown(float(values[0])), grown(float(values[wanted - 1]))
    degree = np.log(residual / TOLERANCE * 100) / last
    if first > last:
        degree = min(degree, np.log(SPREAD) / (first - last))
    scale = half / (float(values[0]) - middle)
    now, old, s = (aq - middle * q) * (scale / half), q, scale
    for _ in range(1, int(np.clip(np.ceil(degree), 2, 24))):
        new = 1 / (2 / scale - s)
        now, old = (times(now) - middle * now) * (2 * new / half) - (s * new) * old, now
        s = new
    return now


class _Lanczos:
    """A few steps of the Lanczos recurrence, and what they say of the least eigenvalue."""

    def __init__(self, start: np.ndarray, steps: int = 12):
        self.basis, self.steps = [start / np.linalg.norm(start)], min(steps, len(start))
        self.alpha: list[float] = []
        self.beta: list[float] = []

    def column(self) -> np.ndarray | None:
        return self.basis[-1] if len(self.alpha) < self.steps and len(self.basis) > len(self.alpha) else None

    def take(self, product: np.ndarray) -> None:
        self.alpha.append(float(self.basis[-1] @ product))
        held = np.array(self.basis)
        rest = product - held.T @ (held @ product)
        rest -= held.T @ (held @ rest)
        self.beta.append(float(np.linalg.norm(rest)))
        if self.beta[-1] > 1e-12 * max(map(abs, self.alpha)):
            self.basis.append(rest / self.beta[-1])

    def least(self) -> float:
        """A value that the spectrum hardly goes below; 0 while too little is known."""
        if len(self.alpha) < 4:
            return 0.0
        n = len(self.alpha)
        values, vectors = np.linalg.eigh(np.diag(self.alpha) + np.diag(self.beta[: n - 1], 1) + np.diag(self.beta[: n - 1], -1))
        return float(values[0] - self.beta[-1] * abs(vectors[-1, 0]))


def _whole_numbers(rows: int):
    """Vectors as ``floor(64 * c)`` in blocks (a million less than the contract's numbers, which no covariance sees)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(chunks(batches, rows), first_block()):
            x = np.floor(64.0 * matrix(part["vector"].combine_chunks()).astype(np.float64))
            if np.abs(x).max() >= 2.0**52:
                raise OverflowError("an entry of a vector is too large for a whole number of 64ths")
            ids = pa.array([part["id"].combine_chunks().to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), ids, pa.array([x.astype(np.int64).tobytes()], pa.binary())], names=["block", "ids", "x"])

    return run


def _matrices(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[list, np.ndarray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch["ids"][k] if "ids" in batch.schema.names else None, np.frombuffer(batch["x"][k].as_py(), np.int64).reshape(-1, dimension)


def _summed(blocks: DataFrame, dimension: int, each: Callable[[np.ndarray], np.ndarray], size: int, kind: str) -> np.ndarray:
    """The sum over all blocks of ``each`` (a block's whole numbers to ``size`` numbers): tasks add up their own, Spark the tasks'."""
    dtype = {"long": np.int64, "double": np.float64}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype)
        for _, x in _matrices(batches, dimension):
            total += each(x)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.from_numpy_dtype(dtype)))], names=["sums"])

    cells = blocks.select("x").mapInArrow(run, f"sums array<{kind}>").select(F.posexplode("sums").alias("cell", "v"))
    out = np.zeros(size, dtype)
    for r in cells.groupBy("cell").agg(F.sum("v").alias("v")).collect():  # as many rows as the product has cells
        out[r["cell"]] = r["v"]
    return out


def whitened(rows: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding", guard: int = 16) -> tuple[DataFrame, Spectrum]:
    """``vec_id, n, deviation, whitened (array), explained (array), identity_error`` of every row with a whole vector, and the spectrum.

    Entries c count as ``floor(64 * c)``. ``whitened`` has one number for each of the largest ``components`` of the covariance, fewer if it
    has fewer that are not zero (below 1e-12 of the greatest): none for equal rows or a single one. Rows whose vector is null, empty or
    holds null or non-finite numbers, or is of another length than most, are left out; repeated rows and null keys are rows like others; an
    empty table gives an empty result. Keys are whole numbers. Deviations are exact and fail if they need more than 64 bits.
    """
    spark = rows.sparkSession
    out = "vec_id long, n long, deviation long, whitened array<double>"
    held, dimension, _ = usable(rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")), "vector")
    if not dimension:
        none = Spectrum(np.zeros(0), np.zeros((0, 0)), 0.0, 0)
        return spark.createDataFrame([], f"{out}, explained array<double>, identity_error double"), none
    blocks = written(held.mapInArrow(_whole_numbers(rows_a_block(dimension)), "block long, ids array<long>, x binary"), "whitening")
    first = _summed(blocks, dimension, lambda x: np.append(x.sum(0), len(x)), dimension + 1, "long")
    sums, n = first[:-1], int(first[-1])
    mean = sums / n

    def product(q: np.ndarray) -> np.ndarray:
        def each(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return (centred.T @ (centred @ q)).ravel()

        return _summed(blocks, dimension, each, q.size, "double").reshape(q.shape) / n

    found = dominant(product, dimension, components, guard)
    kept = found.values > 1e-12 * max(found.values[0], 1e-300)
    found = Spectrum(found.values[kept], found.vectors[:, kept], found.residual, found.passes)
    axes = found.vectors / np.sqrt(found.values)
    k = axes.shape[1]

    def moments(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        w = centred @ axes
        return np.concatenate([(w.T @ w).ravel(), w.sum(0), [(centred * centred).sum()]])

    last = _summed(blocks, dimension, moments, k * k + k + 1, "double") / n
    centre = last[k * k : -1]
    error = float(np.abs(last[: k * k].reshape(k, k) - np.outer(centre, centre) - np.eye(k)).max()) if k else 0.0
    explained = (found.values / last[-1]).tolist() if k else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, dimension):
            far = n * x.astype(object) - sums.astype(object) if n * float(np.abs(x).max()) * 2 > 2**62 else n * x - sums
            far = far.astype(object) if float(np.abs(far).max()) ** 2 * dimension > 2**62 else far
            w = (x - mean) @ axes
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.values, pa.array([n] * len(x), pa.int64()), pa.array((far * far).sum(1).tolist(), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(w.ravel(), pa.float64()))],
                names=["vec_id", "n", "deviation", "whitened"],
            )

    done = blocks.select("ids", "x").mapInArrow(run, out)
    return done.select("*", F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error")), found


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    done, _ = whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = done.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error")
