"""Embedding whitening by spectral divide and conquer (operator 11).

Vectors become integers x = floor(256 c). The covariance V of the different
x-vectors (divisor n, centred before multiplying) is taken apart into its
components, and each vector is projected on the leading ones and scaled to unit
variance.

1. One shuffle leaves each different x-vector once; it is written as the fit list.
2. Exact sums, then products of centred vectors, are added up within tasks; one
   row for each task and row of the matrix travels.
3. One task takes a matrix apart by QDWH: the polar factor of the shifted
   covariance, from the dynamically weighted Halley iteration, is the matrix sign;
   (sign + I) / 2 projects on the components above the shift. An orthonormal basis
   of its range and one of the rest split the matrix in two, which are split in
   turn until parts are single components, or multiples of the identity.
4. Sums and components, whose size depends on the length of the vectors alone
   (d numbers a component), go to all tasks, which whiten the rows where they are.

Vectors of different lengths are fitted apart, each length by itself.

Edge cases: vectors that are null, hold null or non-finite entries, or an entry
whose x does not fit 64 bits, are dropped; so are empty ones, which have no
component. Repeated rows, rows that share an id and null ids stay and give rows
of their own, but an x-vector counts once in the fit. Vectors with fewer than
``COMPONENTS`` entries have fewer components. Where a component has no variance
(none that rounding in the matrix leaves accurate) ``whitened`` is null; ``explained`` is null if there is no
variance at all, ``identity_error`` if no component has any. ``deviation`` is null
if it needs more than 38 digits. An empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import written

COMPONENTS = 4
SCALE = 256
#: Vectors multiplied at a time.
ROWS = 2048
#: Relative accuracy of a variance that a vector is scaled by.
ACCURATE = 1e-5
_EPS = float(np.finfo(np.float64).eps)


# --- the matrix: QDWH spectral divide and conquer ---

def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix (for a regular matrix its
    matrix sign), by the dynamically weighted Halley iteration in its inverse-free
    QR form."""
    d = len(matrix)
    largest = np.linalg.norm(matrix)        # Frobenius: at least the spectral norm
    x = matrix / largest
    try:
        least = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        least = 0.0
    least = min(1.0, least) if least > _EPS else _EPS
    identity = np.eye(d)
    for _ in range(50):
        square = least * least
        root = np.cbrt(4 * (1 - square) / (square * square)) if least < 1 else 0.0
        outer = np.sqrt(1 + root)
        a = outer + 0.5 * np.sqrt(8 - 4 * root + 8 * (2 - square) / (square * outer))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, identity]))
        following = b / c * x + (a - b / c) / np.sqrt(c) * (q[:d] @ q[d:].T)
        following = (following + following.T) / 2
        moved = np.linalg.norm(following - x)
        x = following
        least = min(1.0, least * (a + b * square) / (1 + c * square))
        if moved <= np.cbrt(_EPS) and 1 - least <= 10 * _EPS:
            break
    return x


def _split(matrix: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Orthonormal bases of the components above and below ``shift`` and what is
    left between the two parts, or None where one side is empty."""
    d = len(matrix)
    projector = (polar_factor(matrix - shift * np.eye(d)) + np.eye(d)) / 2
    above = int(round(float(np.trace(projector))))
    if not 0 < above < d:
        return None
    # Subspace iteration from a fixed random start; a projector needs a step or two.
    basis = np.random.default_rng(d).standard_normal((d, above))
    for _ in range(3):
        basis, _ = np.linalg.qr(projector @ basis)
    whole, _ = np.linalg.qr(basis, mode="complete")
    upper, lower = whole[:, :above], whole[:, above:]
    return upper, lower, float(np.linalg.norm(lower.T @ matrix @ upper))


def components_of(matrix: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as columns) of the ``wanted`` largest components of a
    symmetric matrix, in falling order. Parts that hold none of these are left
    whole."""
    matrix = (matrix + matrix.T) / 2
    wanted = len(matrix) if wanted is None else min(wanted, len(matrix))
    tolerance = 4 * _EPS * len(matrix) * float(np.linalg.norm(matrix))
    values, vectors = [], []
    # Parts, the upper ones last: (basis, how many components are above it).
    parts = [(np.eye(len(matrix)), 0)]
    while parts:
        basis, above = parts.pop()
        if above >= wanted:
            continue
        part = basis.T @ matrix @ basis
        part = (part + part.T) / 2
        size, mean = len(part), float(np.trace(part)) / len(part)
        if size == 1 or np.linalg.norm(part - mean * np.eye(size)) <= tolerance:
            for i in range(min(size, wanted - above)):
                values.append(float(part[i, i]))
                vectors.append(basis[:, i])
            continue
        # The median of the diagonal halves the work; the mean lies between the
        # least and the largest value, so that one always splits; the others keep
        # away from a value that happens to be the shift.
        spread = float(np.linalg.norm(part - mean * np.eye(size))) / size
        best = None
        for shift in (float(np.median(np.diag(part))), mean, mean + spread / 3, mean - spread / 3, mean + spread / 7):
            found = _split(part, shift)
            if found is not None and (best is None or found[2] < best[2]):
                best = found
            if best is not None and best[2] <= tolerance:
                break
        if best is None:
            raise ArithmeticError("a symmetric part of different components did not split")
        upper, lower, _ = best
        parts.append((basis @ lower, above + upper.shape[1]))
        parts.append((basis @ upper, above))
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], np.array(vectors).T[:, order]


# --- sums over the fit list ---

@dataclass(frozen=True)
class Sums:
    """Of the fit list's vectors of one length: how many, and the exact sums."""
    n: int
    s: list[int]

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and the rest of less than 1."""
        whole = [round_half_down(v, self.n) for v in self.s]
        return np.array(whole, np.int64), np.array([(v - w * self.n) / self.n for v, w in zip(self.s, whole, strict=True)])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part is taken off exactly before rounding."""
        whole, rest = self.centre()
        near = all(-2**61 < v.min(initial=0) and v.max(initial=0) < 2**61 for v in (x, whole))
        difference = x - whole if near else (x.astype(object) - whole.astype(object))
        return difference.astype(np.float64) - rest


def round_half_down(value: int, n: int) -> int:
    return (2 * value + n - 1) // (2 * n)


def _matrices(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, x-vectors) of a batch, ``ROWS`` at a time."""
    vectors = batch.column(column)
    lengths = np.asarray(vectors.value_lengths())
    for d in np.unique(lengths).tolist():
        which = np.flatnonzero(lengths == d)
        for at in range(0, len(which), ROWS):
            rows = which[at:at + ROWS]
            flat = np.asarray(vectors.take(pa.array(rows)).flatten())
            yield d, rows, flat.reshape(-1, d)


SUMS = "d int, i int, n long, high long, low long"


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task in two halves of 32 bits, which do not overflow."""
    held: dict[int, list] = {}
    for batch in batches:
        for d, _, x in _matrices(batch):
            n, high, low = held.get(d) or [0, np.zeros(d, np.int64), np.zeros(d, np.int64)]
            held[d] = [n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)]
    for d, (n, high, low) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n, np.int64)),
             pa.array(high), pa.array(low)], names=["d", "i", "n", "high", "low"])


def sums_of(fit: DataFrame) -> dict[int, Sums]:
    """The sums for each length: d numbers for vectors of length d."""
    wide = "decimal(38,0)"
    rows = (fit.mapInArrow(_add, SUMS).groupBy("d", "i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low"))
            .orderBy("d", "i").collect())
    found: dict[int, Sums] = {}
    for r in rows:
        found.setdefault(r["d"], Sums(r["n"], [])).s.append((int(r["high"]) << 32) + int(r["low"]))
    return found


PRODUCTS = "d int, i int, products array<double>"


def _product_rows(d: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(total), d, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)),
         pa.array(list(total), pa.list_(pa.float64()))], names=["d", "i", "products"])


def _multiply(sums: dict[int, Sums]):
    """Products of a task's centred vectors, a row for each row of the matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _matrices(batch):
                c = sums[d].centred(x)
                held[d] = held.get(d, 0.0) + c.T @ c
        for d, total in held.items():
            yield _product_rows(d, total)
    return run


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows with the same (d, i), which come together."""
    now, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                                           pa.array([total], pa.list_(pa.float64()))], names=["d", "i", "products"])

    for batch in batches:
        for d, i, products in zip(batch.column("d").to_pylist(), batch.column("i").to_pylist(), batch.column("products"), strict=True):
            values = np.asarray(products.values)
            if (d, i) != now:
                if now is not None:
                    yield row()
                now, total = (d, i), np.zeros(d)
            total = total + values
    if now is not None:
        yield row()


MODELS = "d int, component int, value double, total double, direction array<double>"


def _solve(sums: dict[int, Sums], components: int):
    """Rows of one matrix come together, in order: its components."""
    def solved(d: int, rows: list[np.ndarray]) -> pa.RecordBatch:
        matrix = np.array(rows) / sums[d].n
        values, vectors = components_of(matrix, components)
        k = len(values)
        return pa.RecordBatch.from_arrays(
            [pa.array([d] * k, pa.int32()), pa.array(range(1, k + 1), pa.int32()), pa.array(values),
             pa.array([float(np.trace(matrix))] * k), pa.array(list(vectors.T), pa.list_(pa.float64()))],
            names=["d", "component", "value", "total", "direction"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for d, products in zip(batch.column("d").to_pylist(), batch.column("products"), strict=True):
                if d != now:
                    if rows:
                        yield solved(now, rows)
                    now, rows = d, []
                rows.append(np.asarray(products.values))
        if rows:
            yield solved(now, rows)
    return run


@dataclass(frozen=True)
class Model:
    """Components of the vectors of one length."""
    sums: Sums
    values: np.ndarray
    total: float
    directions: np.ndarray      # columns

    @property
    def known(self) -> np.ndarray:
        """The components that have variance: so much that rounding in the matrix
        changes it by less than ``ACCURATE``."""
        return self.values * ACCURATE > _EPS * len(self.directions) * max(self.total, 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """The projections on the components with variance."""
        k = self.known
        return self.sums.centred(x) @ self.directions[:, k] / np.sqrt(self.values[k])


ERRORS = "d int, i int, j int, n long, left double, right double, product double"


def _spread(models: dict[int, Model]):
    """For a task's whitened vectors and each two components: count, means and
    the product centred in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, _, x in _matrices(batch):
                w = models[d].whitened(x)
                means = w.mean(0)
                products = (w - means).T @ (w - means)
                i, j = (m.ravel() for m in np.indices(products.shape))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                     pa.array(np.full(len(i), len(x), np.int64)), pa.array(means[i]), pa.array(means[j]), pa.array(products.ravel())],
                    names=["d", "i", "j", "n", "left", "right", "product"])
    return run


def identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """For each length the largest absolute entry of the covariance of the fit
    list's whitened vectors minus the identity, as measured."""
    n = F.sum("n")
    weighed = F.col("n") * F.col("left")
    covariance = (F.sum("product") + F.sum(weighed * F.col("right")) - F.sum(weighed) * F.sum(F.col("n") * F.col("right")) / n) / n
    rows = fit.mapInArrow(_spread(models), ERRORS).groupBy("d", "i", "j").agg(covariance.alias("v"))
    unit = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.lit(0.0))
    return {r["d"]: r["error"] for r in rows.groupBy("d").agg(F.max(F.abs(F.col("v") - unit)).alias("error")).collect()}


# --- the operator ---

def integers(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that take part."""
    scaled = F.transform(F.col(vector_column).cast("array<double>"), lambda c: c * F.lit(float(SCALE)))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("scaled"))
    fits = F.forall("scaled", lambda c: F.coalesce((c >= -(2.0**63)) & (c < 2.0**63), F.lit(False)))
    return rows.where(F.coalesce(fits & (F.size("scaled") > 0), F.lit(False))).select(
        "vec_id", F.transform("scaled", lambda c: F.floor(c)).alias("x"))


def fitted(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The model of each length. ``fit``: written rows, each x-vector once."""
    sums = sums_of(fit)
    added = (fit.mapInArrow(_multiply(sums), PRODUCTS).repartition("d", "i").sortWithinPartitions("d", "i")
             .mapInArrow(_add_rows, PRODUCTS))
    solved = written(added.repartition("d").sortWithinPartitions("d", "i").mapInArrow(_solve(sums, components), MODELS),
                     "components").orderBy("d", "component").collect()
    models: dict[int, Model] = {}
    for d in sorted({r["d"] for r in solved}):
        own = [r for r in solved if r["d"] == d]
        models[d] = Model(sums[d], np.array([r["value"] for r in own]), own[0]["total"], np.array([r["direction"] for r in own]).T)
    return models


WHITENED = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
            "identity_error double")
_DEVIATION = pa.decimal128(38, 0)


def deviations(x: np.ndarray, sums: Sums) -> list[int]:
    """The sum of (n x - S)^2 over the entries of each vector, exactly."""
    most = sums.n * int(np.abs(x.astype(object)).max(initial=0)) + max(map(abs, sums.s))
    if most * most * x.shape[1] < 2**63:
        apart = sums.n * x - np.array(sums.s, np.int64)
        return (apart * apart).sum(1).tolist()
    apart = sums.n * x.astype(object) - np.array(sums.s, object)
    return (apart * apart).sum(1).tolist()


def _whiten(models: dict[int, Model], errors: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _matrices(batch):
                model = models[d]
                k, n = len(model.values), len(x)
                whitened = np.full((n, k), np.nan)
                whitened[:, model.known] = model.whitened(x)
                missing = np.tile(~model.known, n)
                explained = model.values / model.total if model.total > 0 else np.full(k, np.nan)
                apart = deviations(x, model.sums)
                apart = pa.array([Decimal(v) if v < 10**38 else None for v in apart], _DEVIATION)
                ids = batch.column("vec_id").take(pa.array(np.repeat(rows, k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                     pa.array(np.full(n * k, model.sums.n, np.int64)), apart.take(pa.array(np.repeat(np.arange(n), k))),
                     pa.array(whitened.ravel(), mask=missing), pa.array(np.tile(explained, n), from_pandas=True),
                     pa.array([errors.get(d)] * (n * k), pa.float64())], names=[c.split()[0] for c in WHITENED.split(", ")])
    return run


def whitened(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """One row for each vector that takes part and each of its leading components:
    id, component, n, deviation, whitened, explained, identity_error."""
    rows = integers(vectors, id_column, vector_column)
    fit = written(rows.select("x").distinct(), "fit")
    models = fitted(fit, components)
    return rows.mapInArrow(_whiten(models, identity_errors(fit, models)), WHITENED).withColumnRenamed("vec_id", id_column)
