"""Whitening of embeddings: projections on the leading principal components, scaled to variance 1.

The eigenvectors of the covariance come from a block Jacobi-Davidson iteration. The covariance is
never formed: a product with a block of vectors is one job, in which every task adds up
``(x - mean) ((x - mean) . block)`` over its rows, centred before multiplying, and the sums of the
tasks are added in a fixed order. The driver holds vectors of the width of an embedding only.

- Rayleigh-Ritz: the covariance is projected on a small orthonormal subspace; its eigenpairs give
  Ritz values, Ritz vectors and residuals without another job.
- Correction equations: for each wanted Ritz pair ``(I - QQ')(V - theta I)(I - QQ') t = -r``,
  where ``Q`` has the locked vectors and the Ritz vector, is solved by some steps of MINRES. The
  systems of all pairs advance together, so that a step of all is one product. The solutions
  enlarge the subspace; when it is full it is restarted with the best Ritz vectors.
- Locking: the leading pairs whose residual has come down to double precision (``PRECISION``
  times the largest eigenvalue, about the rounding error of a product) are locked and the
  iteration goes on orthogonal to them. A pair that gains nothing over ``PATIENCE`` rounds is at
  the rounding error of its data and is locked too if it is within 1000 times of that.
  At the end one more projection on the locked vectors orders them.

Entries are scaled to integers, so sums and the deviation from the mean are exact, and a row is
centred by an integer near the mean first and then by the small rest, without cancellation.

Defined results: vectors that are null or hold null or non-finite entries take no part; shorter
ones, the empty one too, are filled up with 0. Entries beyond ``2^52 / scale`` count as that.
Rows whose ids are null or repeated are rows of their own. Components without variance (up to
``FLAT`` of the largest eigenvalue) are left out, so equal vectors or a single one give no rows,
and there are at most as many components as entries. A deviation beyond 64 bits is null. Further
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import forget, ship, store, table

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LARGEST = 2.0**52
#: Residuals, relative to the largest eigenvalue.
PRECISION = 2e-15
PATIENCE = 4
FLAT = 1e-12
#: Pairs that are followed beyond the wanted ones, steps of MINRES, rounds, and vectors in the
#: subspace for each pair.
GUARDS = 2
INNER = 8
ROUNDS = 100
PER_PAIR = 8
#: Sums that reach the driver for each product.
LANES = 64

WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)
Product = Callable[[np.ndarray], np.ndarray]


def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``new`` without their parts in ``against``; columns
    that have nothing of their own are left out."""
    kept: list[np.ndarray] = []
    for column in new.T:
        length = np.linalg.norm(column)
        if not length:
            continue
        column = column / length
        for _ in range(2):  # the second pass takes off what rounding left
            for basis in against:
                column = column - basis @ (basis.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            length = np.linalg.norm(column)
            if length < 1e-10:
                break
            column = column / length
        else:
            kept.append(column)
    return np.array(kept).T if kept else np.empty((len(new), 0))


def minres(apply: Product, right: np.ndarray, steps: int, reduction: float = 1e-3) -> np.ndarray:
    """Approximate solutions of symmetric systems, a column each, all advanced together."""
    norms = np.linalg.norm(right, axis=0)
    open_ = norms > 0
    v = right / np.where(open_, norms, 1)
    v_before, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    solution = np.zeros_like(v)
    beta, left = np.zeros_like(norms), norms.copy()
    cos, cos_before = np.ones_like(norms), np.ones_like(norms)
    sin, sin_before = np.zeros_like(norms), np.zeros_like(norms)
    for _ in range(steps):
        following = apply(v)
        alpha = (v * following).sum(0)
        following = following - alpha * v - beta * v_before
        beta_next = np.linalg.norm(following, axis=0)
        delta = cos * alpha - cos_before * sin * beta
        rho = np.hypot(delta, beta_next)
        open_ &= rho > 0
        safe = np.where(open_, rho, 1)
        upper = sin * alpha + cos_before * cos * beta
        highest = sin_before * beta
        w_next = (v - highest * w_before - upper * w) / safe
        cos_before, cos = cos, np.where(open_, delta / safe, 1)
        sin_before, sin = sin, np.where(open_, beta_next / safe, 0)
        solution += np.where(open_, cos * left, 0) * w_next
        left = np.where(open_, -sin * left, 0)
        w_before, w = w, w_next
        open_ &= (beta_next > 1e-14 * norms) & (np.abs(left) > reduction * norms)
        if not open_.any():
            break
        v_before, v = v, following / np.where(beta_next > 0, beta_next, 1)
        beta = beta_next
    return solution


def leading_eigenpairs(
    product: Product,
    width: int,
    wanted: int,
    precision: float = PRECISION,
    guards: int = GUARDS,
    inner: int = INNER,
    seed: int = 11,
) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric positive operator of which
    only products with blocks are known."""
    wanted = min(wanted, width)
    pairs = min(width, wanted + guards)
    most = max(2 * pairs, PER_PAIR * pairs)
    random = np.random.default_rng(seed)
    locked = np.empty((width, 0))
    basis, images = np.empty((width, 0)), np.empty((width, 0))
    new = random.standard_normal((width, pairs))
    largest, best, idle = 0.0, math.inf, 0
    for _ in range(ROUNDS):
        new = orthonormal(new, locked, basis)
        if not new.shape[1] and basis.shape[1] + locked.shape[1] < width:
            new = orthonormal(random.standard_normal((width, pairs)), locked, basis)
        if new.shape[1]:
            basis, images = np.c_[basis, new], np.c_[images, product(new)]
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        largest = max(largest, values[0])
        deflated = images - locked @ (locked.T @ images)
        residuals = deflated - basis * values
        sizes = np.linalg.norm(residuals, axis=0)
        limit = precision * largest
        idle = 0 if sizes[0] < 0.5 * best else idle + 1
        best = min(best, sizes[0])
        done = 0
        while done < len(values) and locked.shape[1] + done < wanted and (
            sizes[done] <= limit or (idle >= PATIENCE and sizes[done] <= 1000 * limit)
        ):
            done += 1
        if done:
            locked = np.c_[locked, orthonormal(basis[:, :done], locked)]
            best, idle = math.inf, 0
        if locked.shape[1] == wanted:
            break
        basis, images = basis[:, done:], images[:, done:]
        residuals, values = residuals[:, done:], values[done:]
        if basis.shape[1] + pairs > most:
            basis, images = basis[:, : 2 * pairs], images[:, : 2 * pairs]
        count = min(pairs - locked.shape[1], len(values))
        ritz, shifts = basis[:, :count], values[:count]

        def project(block: np.ndarray, ritz=ritz, locked=locked) -> np.ndarray:
            block = block - ritz * (ritz * block).sum(0)
            return block - locked @ (locked.T @ block)

        def corrected(block: np.ndarray, project=project, shifts=shifts) -> np.ndarray:
            block = project(block)
            return project(product(block) - block * shifts)

        if basis.shape[1] + locked.shape[1] < width:
            new = minres(corrected, project(-residuals[:, :count]), inner)
        else:
            new = np.empty((width, 0))
    else:
        raise ArithmeticError("the eigenvectors did not reach double precision")
    small = locked.T @ product(locked)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], (locked @ turn)[:, ::-1]


def whole_vectors(embeddings: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and x: the usable vectors as integers."""
    finite = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    whole = F.transform(
        "embedding",
        lambda c: F.floor(
            F.greatest(F.least(c.cast("double") * scale, F.lit(LARGEST)), F.lit(-LARGEST))
        ).cast("long")
        + offset,
    )
    return embeddings.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x")
    )


def _matrix(batch: pa.RecordBatch, width: int, offset: int) -> np.ndarray:
    lists = batch.column("x")
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(lists), width), offset, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def add_up(
    rows: DataFrame, tasks: int, shape: tuple[int, ...], of_batch: Callable, lanes: int = LANES
) -> np.ndarray:
    """The sum over all batches of an array of doubles. Tasks add their own; so many tasks that
    their sums would crowd the driver are first added in ``lanes`` groups. Always in the order
    of the tasks, so that runs agree."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += of_batch(batch)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {
                "task": pa.array([task], pa.int32()),
                "part": pa.array([total.astype("<f8").tobytes()], pa.binary()),
            }
        )

    def merged(group: pa.Table) -> pa.Table:
        ordered = group.sort_by("task")
        total = np.zeros(shape)
        for part in ordered.column("part").to_pylist():
            total += np.frombuffer(part, "<f8").reshape(shape)
        return pa.table(
            {
                "task": pa.array([ordered.column("task")[0].as_py()], pa.int32()),
                "part": pa.array([total.tobytes()], pa.binary()),
            }
        )

    schema = "task int, part binary"
    parts = rows.mapInArrow(summed, schema)
    if tasks > lanes:
        parts = parts.groupBy(F.pmod("task", F.lit(lanes))).applyInArrow(merged, schema)
    total = np.zeros(shape)
    for row in sorted(parts.collect(), key=lambda r: r["task"]):
        total += np.frombuffer(row["part"], "<f8").reshape(shape)
    return total


def exact_sums(rows: DataFrame, width: int, offset: int) -> tuple[list[int], int]:
    """The sum of each entry over all rows, exact, and the number of tasks that read them."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):  # 1000 entries of 2^52 are below 2^63
                part = _matrix(batch.slice(at, 1000), width, offset).sum(0).tolist()
                total = [a + b for a, b in zip(total, part, strict=True)]
        yield pa.RecordBatch.from_pydict(
            {
                "place": pa.array(range(width), pa.int32()),
                "part": pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
            }
        )

    parts = rows.mapInArrow(summed, "place int, part decimal(38,0)")
    found = (
        parts.groupBy("place")
        .agg(F.sum("part").alias("total"), F.count(F.lit(1)).alias("tasks"))
        .collect()
    )
    sums = {row["place"]: int(row["total"]) for row in found}
    return [sums[place] for place in range(width)], max(row["tasks"] for row in found)


def deviations(x: np.ndarray, base: np.ndarray, rest: list[int], n: int) -> list[int | None]:
    """For each row the sum over entries of ``(n * x - S)^2``, where S is ``n * base + rest``."""
    away = x - base
    bound = n * int(np.abs(away).max(initial=0)) + max(map(abs, rest), default=0)
    if bound * bound * max(1, x.shape[1]) < 2**63:
        return ((n * away - np.array(rest, np.int64)) ** 2).sum(1).tolist()
    exact = [
        sum((n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in away.tolist()
    ]
    return [value if value < 2**63 else None for value in exact]


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = store(whole_vectors(embeddings, scale, offset), "whole-vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    empty = spark.createDataFrame([], WHITENED)
    if not n or not width:
        return empty
    sums, tasks = exact_sums(rows, width, offset)
    nearest = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * b for s, b in zip(sums, nearest, strict=True)]
    base, shift = np.array(nearest, np.int64), np.array([r / n for r in rest])

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (_matrix(batch, width, offset) - base).astype(float) - shift

    def product(block: np.ndarray) -> np.ndarray:
        def of_batch(batch: pa.RecordBatch) -> np.ndarray:
            x = centred(batch)
            return x.T @ (x @ block)

        return add_up(rows, tasks, block.shape, of_batch) / n

    square = add_up(rows, tasks, (1,), lambda b: np.array([(centred(b) ** 2).sum()]))
    trace = float(square[0]) / n
    if not trace:
        return empty
    values, vectors = leading_eigenpairs(product, width, components)
    real = int((values > FLAT * values[0]).sum())
    values, axes = values[:real], vectors[:, :real] / np.sqrt(values[:real])
    # How far the whitened rows themselves are from unit covariance.
    mean = add_up(rows, tasks, (real,), lambda b: (centred(b) @ axes).sum(0)) / n

    def outer(batch: pa.RecordBatch) -> np.ndarray:
        white = centred(batch) @ axes - mean
        return white.T @ white

    spread = add_up(rows, tasks, (real, real), outer) / n
    error = float(np.abs(spread - np.eye(real)).max())
    explained = values / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, width, offset)
            white = centred(batch) @ axes
            count = len(x)
            each = pa.array(np.repeat(np.arange(count), real))
            away = pa.array(deviations(x, base, rest, n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, real + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * real, n, np.int64)),
                    away.take(each),
                    pa.array(white.reshape(-1)),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * real, error)),
                ],
                [part.split()[0] for part in WHITENED.split(", ")],
            )

    result = store(rows.mapInArrow(project, WHITENED), "whitened")
    forget(spark, rows)
    return result


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
