"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed.  Its product with a block of `block` columns is one distributed pass over the
vectors: each task subtracts the mean, multiplies by the block and by itself transposed, and sends a row for each dimension;
Spark adds these up.  A polynomial recurrence over such passes damps the unwanted end of the spectrum, QR makes the block
orthonormal again, and Rayleigh-Ritz picks the best directions in it.  Rounds go on until the residual of every wanted
direction certifies it.  What reaches the driver is dimensions x block numbers, whatever the number of vectors.

Rows that are left out: those whose vector is null, empty, or holds null or a non-finite entry, and those of another length
than the commonest one (of equally common lengths the greater one counts).  Rows may repeat, and ids may be null or repeat: every
remaining row is returned, while a vector counts once in the fit however many rows have it.  Where fewer than the wanted
directions carry any variance, only these are returned; without any row, or where all vectors are equal, the result has no rows.
An entry beyond the range of a long becomes the nearest long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.llm.common import stored

#: Directions wanted, columns of the block, passes of a filter, rounds after which a fit is given up.
COMPONENTS, BLOCK, DEGREE, MAX_ROUNDS = 4, 32, 10, 60
#: A direction is certified where its residual is at most this share of the greatest eigenvalue.
TOLERANCE = 1e-14
#: A direction carries variance from this share of the trace on.
NO_VARIANCE = 1e-12
#: Steps of one unit of an entry.
SCALE = 256
SEED = 20


@dataclass(frozen=True)
class Whitening:
    """`directions` has a column for each component, by falling eigenvalue; `sums` and `n` are exact."""

    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    rounds: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and `x`, the scaled entries as longs, of the rows that remain."""
    entries = F.col("embedding").cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = F.transform(entries, lambda c: F.floor(F.lit(float(SCALE)) * c).cast("long"))
    rows = embeddings.where(entries.isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x")).where(F.size("x") > 0)
    commonest = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("x") == (commonest["length"] if commonest else 0))


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """The column `x` of each batch as an n x d matrix of longs."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column(batch.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, d)


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension; halves of 32 bits are added apart, so that none overflows."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                names = ["i", "n", "high", "low"]
                columns = [np.arange(x.shape[1]), np.full(x.shape[1], len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    parts = fit.select("x").mapInArrow(halves, "i long, n long, high long, low long")
    wide = "decimal(38,0)"
    total = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(28,0)")).cast(wide).alias("high"), F.sum(F.col("low").cast("decimal(28,0)")).cast(wide).alias("low"))
    rows = sorted(total.collect(), key=lambda r: r["i"])
    return (rows[0]["n"] if rows else 0), [int(r["high"]) * (1 << 32) + int(r["low"]) for r in rows]


def _added_up(fit: DataFrame, shape: tuple[int, int], d: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of `part` over all batches of vectors: a row of the sum is a row of Spark's, its columns are added by Spark."""
    columns = [f"y{j}" for j in range(shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for x in _matrices(batches, d):
            total += part(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape[0])), *(pa.array(c) for c in total.T)], names=["i", *columns])

    parts = fit.select("x").mapInArrow(run, "i long, " + ", ".join(f"{c} double" for c in columns))
    # A row for each dimension is left: few tasks are enough, also where the session has many shuffle partitions.
    rows = parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in columns)).coalesce(4).collect()
    return np.array([[r[c] for c in columns] for r in sorted(rows, key=lambda r: r["i"])])


def covariance_product(fit: DataFrame, n: int, mean: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """The covariance matrix as a function on blocks, one pass over the vectors a call."""

    def times(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)

        return _added_up(fit, block.shape, len(mean), part) / n

    return times


def chebyshev_filter(times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, first: np.ndarray, degree: int, low: float, high: float) -> np.ndarray:
    """The Chebyshev polynomial of `degree` on 0..`low` of the covariance, times `block`; scaled to about one at `high`, so
    that nothing overflows.  `first` is the covariance times `block`, known from the step before."""
    centre = half = low / 2
    scale = ratio = half / (high - centre)
    before, now = block, (first - centre * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / ratio - scale)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - scale * following * before
        scale = following
    return now


def top_directions(times: Callable[[np.ndarray], np.ndarray], d: int, trace: float, wanted: int = COMPONENTS, width: int = BLOCK, degree: int = DEGREE, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, int]:
    """Unit eigenvectors and eigenvalues of the `wanted` greatest eigenvalues, and the rounds that it took.

    A fit that is not certified after `MAX_ROUNDS` rounds raises.
    """
    width, wanted = min(width, d), min(wanted, d)
    block = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, width)))[0]
    worst = np.inf
    for rounds in range(1, MAX_ROUNDS + 1):
        image = times(block)
        inner = block.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        kept = int((values[:wanted] > NO_VARIANCE * trace).sum())
        left = image[:, :kept] - block[:, :kept] * values[:kept]
        before, worst = worst, float(np.linalg.norm(left, axis=0).max(initial=0.0))
        # A whole basis is exact at once.  Rounding can hold a residual a little above the tolerance: then it no longer falls.
        small = worst <= tolerance * max(values[0], 0.0)
        if width == d or kept == 0 or small or (worst <= 100 * tolerance * values[0] and worst > before / 2):
            return block[:, :kept], values[:kept], rounds
        low = max(values[-1], 1e-6 * values[0])
        block = np.linalg.qr(chebyshev_filter(times, block, image, degree, low, values[0]))[0]
    raise RuntimeError(f"not certified after {MAX_ROUNDS} rounds: the worst residual is {worst:g} at a greatest eigenvalue of {values[0]:g}")


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on each distinct vector `x` of `vectors` once."""
    fit = stored(vectors.select("x").distinct())
    n, sums = exact_sums(fit)
    d = len(sums)
    empty = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, 0)
    if n == 0:
        return empty
    mean = empty.mean
    trace = float(_added_up(fit, (d, 1), d, lambda x: ((x - mean) ** 2).sum(axis=0)[:, None]).sum()) / n
    if trace <= 0:
        return empty
    directions, values, rounds = top_directions(covariance_product(fit, n, mean), d, trace, components)
    unit = directions / np.sqrt(values)
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ unit
        return np.vstack([white.T @ white, white.sum(axis=0)])

    found = _added_up(fit, (k + 1, k), d, moments) / n
    error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    return Whitening(n, sums, directions, values, trace, error, rounds)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n*x - S)^2, exact: in longs where none can overflow, else in whole numbers of any size."""
    most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums))
    exact = x if most * most * x.shape[1] < 1 << 63 else x.astype(object)
    return ((n * exact - np.array(sums, dtype=exact.dtype)) ** 2).sum(axis=1).tolist()


def whiten(vectors: DataFrame, fit: Whitening) -> DataFrame:
    """Per row of `vectors`: vec_id, deviation (an exact whole number as text, for it can pass any number type) and
    `whitened`, an entry for each component of `fit`."""
    mean, unit, d = fit.mean if fit.n else np.zeros(0), fit.directions / np.sqrt(fit.values), len(fit.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in _matrices([batch], d):
                white = (x - mean) @ unit
                columns = [batch.column(0), pa.array(map(str, _deviations(x, fit.n, fit.sums)), pa.string()), pa.array(list(white), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    return vectors.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation string, whitened array<double>")


def whitening_digest(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: vec_id, component (from 1), n, deviation, whitened, explained (share of the trace)
    and identity_error.  A deviation beyond the range of a long is null."""
    vectors = whole_vectors(embeddings)
    fit = fit_whitening(vectors, components)
    shares = F.array(*(F.lit(float(v / fit.trace)) for v in fit.values)).cast("array<double>")
    rows = whiten(vectors, fit).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as bigint)").alias("deviation"),
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(fit.identity_error).alias("identity_error"),
    )
