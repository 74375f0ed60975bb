"""Whitening of embeddings on the leading components of their covariance, found by a block Jacobi-Davidson method.

Entries become integers, x = floor(scale * c) + shift. The covariance V is never formed: the cluster only computes products
of V with a narrow block, each task centring its rows exactly in integers (n * x - S, S the sums of the dimensions) before
multiplying, and tasks' results are added in groups of at most FAN. A search space grows by the solutions of the correction
equations (I - QQ')(V - theta I)(I - QQ') t = -r, Q holding the locked and the current vectors, which an inner MINRES solves
for all wanted components at once, so that one pass over the vectors serves all of them. Rayleigh-Ritz on the space gives
the next approximations; leading pairs are locked, in falling order, once their residuals reach double precision. A full
space restarts from its best vectors. The driver holds the space only: the dimension times at most SPACE blocks of numbers.

Defined results: vectors that are null or empty, or hold null or non-finite entries, take no part. Vectors of each length
are a fit list of their own. Rows with a repeated or a null id are rows like others. An entry's scaled value is cut to
+-2**52 before the shift. Components whose eigenvalue is not above rounding (equal vectors, one vector, more components than
dimensions) are not returned. Each component's largest entry is positive. A deviation beyond 64 bits is the largest long.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import ship
from kerbside.session import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
SPARE = 2  # further pairs that are approximated, so that the last wanted one has no close rival outside the space
SPACE = 6  # blocks in the search space before it restarts
INNER, INNER_GAIN = 6, 0.1  # MINRES steps at most, and the reduction of the residual that ends them
ROUNDS = 60
PRECISION = 2.0**-52  # residuals end below this times a small multiple of the square root of the dimension
FAN = 64  # partial results that are added in one place
_LIMIT = float(1 << 52)
_LONG = (1 << 63) - 1


class NotConverged(RuntimeError):
    """The residuals didn't reach double precision within the allowed rounds."""


# -- the eigenproblem; ``product`` is all it knows of the matrix ------------------------------------------------------

Product = Callable[[np.ndarray], np.ndarray]


def _lengths(block: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->j", block, block))


def orthonormal_to(space: np.ndarray, block: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal columns of ``space``."""
    out = []
    for column in block.T:
        before = np.linalg.norm(column)
        basis = np.column_stack([space, *out]) if out else space
        for _ in range(3):
            column = column - basis @ (basis.T @ column)
        length = np.linalg.norm(column)
        if length > 1e-12 * before > 0:
            out.append(column / length)
    return np.column_stack(out) if out else np.zeros((len(block), 0))


def minres(apply: Product, right: np.ndarray, steps: int, gain: float) -> np.ndarray:
    """Approximate solutions of one symmetric system a column, with one application of all operators a step."""
    beta = _lengths(right)
    start = np.where(beta > 0, beta, 1.0)
    v, v_before = right / start, np.zeros_like(right)
    x, w, w_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta, beta = beta.copy(), np.zeros_like(beta)
    c, c_before, s, s_before = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - alpha * v - beta * v_before
        following = _lengths(p)
        diagonal = c * alpha - c_before * s * beta
        first = np.hypot(diagonal, following)
        first = np.where(first > 0, first, 1.0)
        second, third = s * alpha + c_before * c * beta, s_before * beta
        w, w_before = (v - third * w_before - second * w) / first, w
        c_before, c = c, diagonal / first
        s_before, s = s, following / first
        x = x + c * eta * w
        eta = -s * eta
        v_before, v = v, p / np.where(following > 0, following, 1.0)
        beta = following
        if (np.abs(eta) <= gain * start).all():
            break
    return x


@dataclass(frozen=True)
class Pairs:
    values: np.ndarray
    vectors: np.ndarray  # one a column
    residuals: np.ndarray  # relative to the largest value
    products: int


def leading_pairs(product: Product, size: int, count: int, seed: int = 7, rounds: int = ROUNDS) -> Pairs:
    """The ``count`` largest eigenvalues of a symmetric positive semidefinite matrix, falling, with unit vectors."""
    count = min(count, size)
    block = min(count + SPARE, size)
    used = 0

    def multiply(vectors: np.ndarray) -> np.ndarray:
        nonlocal used
        used += 1
        return product(vectors)

    locked, values, residuals = np.zeros((size, 0)), [], []
    space = orthonormal_to(locked, np.random.default_rng(seed).standard_normal((size, block)))
    image = multiply(space)
    for _ in range(rounds):
        small = space.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        largest = max([*values[:1], ritz[0], 0.0]) if len(ritz) else 0.0
        enough = PRECISION * 4 * (size**0.5) * largest
        wanted = min(count - len(values), len(ritz))
        rest = image - space * ritz
        rest = rest - locked @ (locked.T @ rest)
        sizes = _lengths(rest)
        done = 0
        while done < wanted and sizes[done] <= enough:
            done += 1
        if done:
            locked = np.column_stack([locked, space[:, :done]])
            values += ritz[:done].tolist()
            residuals += (sizes[:done] / (largest or 1.0)).tolist()
            space, image, ritz, rest = space[:, done:], image[:, done:], ritz[done:], rest[:, done:]
        if len(values) == count:
            return Pairs(np.array(values), locked, np.array(residuals), used)
        if space.shape[1] >= SPACE * block:
            space, image = space[:, : 2 * block], image[:, : 2 * block]
        # Correction equations of the wanted and the spare pairs, all orthogonal to the locked and the current vectors.
        near = min(block - len(values), space.shape[1])
        fixed = np.column_stack([locked, space[:, :near]])
        project = lambda t: t - fixed @ (fixed.T @ t)
        shifts = ritz[:near]

        def corrected(t, project=project, shifts=shifts):
            t = project(t)
            return project(multiply(t) - shifts * t)

        room = size - fixed.shape[1]
        if room == 0:
            continue
        steps = minres(corrected, -project(rest[:, :near]), min(INNER, room), INNER_GAIN)
        grown = orthonormal_to(np.column_stack([locked, space]), steps)
        if not grown.shape[1]:  # nothing but rounding is left: look in a new direction
            grown = orthonormal_to(np.column_stack([locked, space]), np.random.default_rng(used).standard_normal((size, 1)))
        if grown.shape[1]:
            space, image = np.column_stack([space, grown]), np.column_stack([image, multiply(grown)])
        elif space.shape[1] + locked.shape[1] == size:  # the space is everything: products anew, free of drift
            image = multiply(space)
    raise NotConverged(f"{len(values)} of {count} components after {rounds} rounds and {used} products")


# -- sums over the rows of a table ------------------------------------------------------------------------------------


def added(partials: DataFrame, parts: int) -> np.ndarray:
    """The sum of equally shaped arrays of doubles, held as bytes in one row a task, added FAN at a time."""

    def add(batches):
        total = None
        for batch in batches:
            for piece in batch.column(0).to_pylist():
                piece = np.frombuffer(piece)
                total = piece.copy() if total is None else total + piece
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    while parts > FAN:
        parts = -(-parts // FAN)
        partials = partials.repartition(parts).mapInArrow(add, "sums binary")
    return sum(np.frombuffer(row.sums) for row in partials.collect())


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def block_of(df: DataFrame, parts: int, compute: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of ``compute`` (a batch to a block of the shape)."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += compute(batch)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return added(df.mapInArrow(run, "sums binary"), parts).reshape(shape)


def integer_entries(df: DataFrame, vector: str, scale: int, shift: int) -> DataFrame:
    """The rows that take part, with ``x``: their entries as integers."""
    values = F.col(f"`{vector}`")
    fine = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))

    def whole(c):
        scaled = F.greatest(F.least(c.cast("double") * F.lit(float(scale)), F.lit(_LIMIT)), F.lit(-_LIMIT))
        return F.floor(scaled).cast("long") + F.lit(shift).cast("long")

    return df.where(values.isNotNull() & (F.size(values) > 0) & fine).withColumn("x", F.transform(values, whole))


def exact_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length of vectors: how many there are and the exact sums of their dimensions."""

    def partial(batches):
        sums: dict[int, list[int]] = {}
        for batch in batches:
            sizes = np.asarray(batch.column(0).value_lengths())
            for d in np.unique(sizes).tolist():
                x = _matrix(batch.column(0).filter(pa.array(sizes == d)))
                held = sums.setdefault(d, [0] * (d + 1))
                for start in range(0, len(x), 512):  # 512 entries below 2**53 can't overflow
                    for i, s in enumerate([len(x[start : start + 512]), *x[start : start + 512].sum(0).tolist()]):
                        held[i] += s
        rows = [(d, i, Decimal(s)) for d, held in sums.items() for i, s in enumerate(held)]
        columns = list(zip(*rows)) if rows else [[], [], []]
        kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["d", "i", "s"])

    total = vectors.select("x").mapInArrow(partial, "d int, i int, s decimal(38,0)").groupBy("d", "i").agg(F.sum("s").alias("s"))
    found: dict[int, list[tuple[int, int]]] = {}
    for row in total.collect():
        found.setdefault(row.d, []).append((row.i, int(row.s)))
    return {d: (sorted(rows)[0][1], [s for _, s in sorted(rows)[1:]]) for d, rows in found.items()}


@dataclass(frozen=True)
class Centre:
    """Exact centring: ``n * x - S`` as integers, in 64 bits where they fit."""

    n: int
    sums: list[int]

    def times_n(self, x: np.ndarray) -> np.ndarray:
        reach = max(int(np.abs(x).max(initial=0)), 1) * self.n + max(map(abs, self.sums), default=0)
        if reach <= _LONG:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.times_n(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        far = self.times_n(x)
        if far.dtype != object and len(far):
            reach = int(np.abs(far).max())
            if reach * reach * far.shape[1] > _LONG:
                far = far.astype(object)
        return [min(int(s), _LONG) for s in (far * far).sum(1)]


@dataclass(frozen=True)
class Whitening:
    """A fitted list: its centre, and the unit vectors and eigenvalues of its leading components."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.vectors / np.sqrt(self.values)


def fit_lists(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A fit of the vectors of each length; ``vectors`` holds ``x`` and is read once for every product."""
    fits, parts = {}, vectors.rdd.getNumPartitions()
    for d, (n, sums) in exact_sums(vectors).items():
        centre, own = Centre(n, sums), vectors.where(F.size("x") == d).select("x")

        def product(block, centre=centre, own=own, d=d, n=n):  # one pass over the vectors
            def compute(batch):
                x = centre(_matrix(batch.column(0)))
                return x.T @ (x @ block)

            return block_of(own, parts, compute, (d, block.shape[1])) / n

        def spread(batch, centre=centre):
            return np.array([[(centre(_matrix(batch.column(0))) ** 2).sum()]])

        trace = float(block_of(own, parts, spread, (1, 1))[0, 0]) / n
        pairs = leading_pairs(product, d, components) if trace > 0 else Pairs(np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0)
        real = pairs.values > 1e-13 * trace
        u = pairs.vectors[:, real]
        u = u * np.where(np.take_along_axis(u, np.abs(u).argmax(0)[None], 0)[0] < 0, -1.0, 1.0) if u.size else u
        fit = Whitening(centre, u, pairs.values[real], trace, 0.0)
        k = u.shape[1]
        if k:
            mean = block_of(own, parts, lambda b, f=fit: f.whitened(_matrix(b.column(0))).sum(0, keepdims=True), (1, k)) / n

            def outer(batch, fit=fit, mean=mean):
                y = fit.whitened(_matrix(batch.column(0))) - mean
                return y.T @ y

            error = float(np.abs(block_of(own, parts, outer, (k, k)) / n - np.eye(k)).max())
            fit = Whitening(centre, u, pairs.values[real], trace, error)
        fits[d] = fit
    return fits


def whiten(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component."""
    spark = df.sparkSession
    ship(spark)
    key = df.schema[id]
    vectors = integer_entries(df, vector, scale, shift).select(F.col(f"`{id}`").alias("id"), "x")
    vectors = stored(vectors, "whitening-vectors")
    fits = fit_lists(vectors, components)

    def rows(batches):
        for batch in batches:
            sizes = np.asarray(batch.column(1).value_lengths())
            for d in np.unique(sizes).tolist():
                fit = fits[d]
                k = len(fit.values)
                part = batch.filter(pa.array(sizes == d))
                x = _matrix(part.column(1))
                numbers = fit.whitened(x).reshape(-1)
                each = np.repeat(np.arange(len(x)), k)
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), fit.centre.n)),
                        pa.array(np.array(fit.centre.deviations(x), np.int64)[each]),
                        pa.array(numbers),
                        pa.array(np.tile(fit.values / (fit.trace or 1.0), len(x))),
                        pa.array(np.full(len(each), fit.identity_error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    fields = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = vectors.mapInArrow(rows, f"id {key.dataType.simpleString()}, {fields}")
    return out.withColumnRenamed("id", id)
