"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become integers, floor(scale * c), so that sums are exact; a constant added
to all of them would cancel everywhere, so none is carried. The fit list is each
distinct vector once; copies meet as packed integers (a byte an entry where that
suffices), combined before they are shuffled.

Three passes read the fit list, and each task gives one row: entry sums; the
scatter of the centred vectors z = (n x - S) / n, where n x - S is an exact
integer; and, once the components are known, the covariance of the whitened
values, by which the result is judged. What reaches the driver is a matrix of
dimension squared, however many rows there are.

The scatter A is factored by Cholesky with diagonal pivoting, P' A P = L L', until
what is left of the diagonal is below rounding: that is the rank. Jacobi rotations
then act on the columns of L itself until they are orthogonal, without forming a
product again, so small eigenvalues keep their digits. The squared norms of the
columns are the eigenvalues of A, the normalised columns, rows put back in place,
its eigenvectors.

``whiten`` returns a row per input row that takes part and component (numbered
from 1 by falling eigenvalue, ``components`` at most): vec_id, component, n,
deviation, whitened, explained, identity_error. Each component's largest entry is
positive. Vectors that are null, empty, or hold null or non-finite entries take no
part. A table has one vector length: where there are several, the one with the most
distinct vectors is fitted (the longer of two with equally many) and the rest takes no part. Copies
count once in the fit and each of them is returned; null ids stay null. No
components, and so no rows, come from directions without variance: from an
empty table, a single vector, or copies of one. Entries beyond 2^62 take no part; a
deviation beyond 63 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.llm.components import written

WIDTHS = ("<i1", "<i2", "<i4", "<i8")
BATCH = 4096
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class WhiteningSpec:
    components: int = 16
    scale: float = 64.0


# --- vectors as packed integers ------------------------------------------------


def pack_vector(values: np.ndarray) -> bytes:
    """Integers in the narrowest width that holds them all, so that equal vectors have equal bytes."""
    for i, kind in enumerate(WIDTHS):
        limit = np.iinfo(kind)
        if values.min() >= limit.min and values.max() <= limit.max:
            return bytes([i]) + values.astype(kind).tobytes()
    raise ValueError("integers of more than 64 bits")


def unpack_vectors(packed: list[bytes]) -> np.ndarray:
    rows = [np.frombuffer(p, WIDTHS[p[0]], offset=1) for p in packed]
    return np.stack(rows).astype(np.int64)


def _pack(scale: float):
    """floor(scale * c) of each vector, packed."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, packed = [], [], []
            for vec_id, one in zip(batch.column("vec_id"), batch.column("embedding"), strict=True):
                values = np.floor(scale * one.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.abs(values).max() < 2.0**62:
                    ids.append(vec_id.as_py())
                    lengths.append(len(values))
                    packed.append(pack_vector(values.astype(np.int64)))
            columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "length", "vector"])

    return each


def packed_vectors(vectors: DataFrame, spec: WhiteningSpec) -> DataFrame:
    """vec_id, length, vector of the rows that take part."""
    raw = F.col("embedding")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    rows = vectors.filter(raw.isNotNull() & (F.size(raw) > 0) & finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(_pack(spec.scale), "vec_id long, length int, vector binary")


# --- one row per task ----------------------------------------------------------


def _per_task(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], kind: type) -> list[np.ndarray]:
    """Sums of ``work`` over all vectors, a partial sum per task: an array of fixed size each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            vectors = batch.column("vector")
            for begin in range(0, len(vectors), BATCH):
                more = work(unpack_vectors(vectors.slice(begin, BATCH).to_pylist()))
                total = more if total is None else total + more
        if total is not None:
            # Integers beyond 64 bits travel as text.
            values = [str(v) for v in total.ravel().tolist()] if kind is int else None
            doubles = None if kind is int else total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(values or [None] * total.size, pa.string()),
                 pa.array(doubles if doubles is not None else [None] * total.size, pa.float64())],
                ["place", "whole", "part"],
            )

    sums = rows.select("vector").mapInArrow(each, "place int, whole string, part double").groupBy("place")
    total = F.sum(F.col("whole").cast("decimal(38,0)")) if kind is int else F.sum("part")
    return [kind(r[1]) for r in sums.agg(total).orderBy("place").collect()]


@dataclass(frozen=True)
class Centre:
    n: int
    sums: list[int]  # of floor(scale * c), per dimension

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n x - S as integers."""
        small = np.abs(x).max(initial=0)
        if self.n * int(small) + max(map(abs, self.sums)) < 2**62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.exact(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        z = self.exact(x)
        if z.dtype != object and np.abs(z).max(initial=0) < 2**31 // max(1, int(np.sqrt(z.shape[1])) + 1):
            return (z * z).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in z.tolist()]
        return [v if v < 2**63 else None for v in exact]


# --- eigenvectors --------------------------------------------------------------


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with matrix[order][:, order] = L L'; as many columns as the matrix has rank."""
    a = matrix.copy()
    d = len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    floor = d * np.finfo(float).eps * max(0.0, a.diagonal().max(initial=0.0))
    for k in range(d):
        rest = a.diagonal()[k:]
        at = k + int(np.argmax(rest))
        if not a[at, at] > floor:
            return factor[:, :k], order
        for m in (a, factor):
            m[[k, at]] = m[[at, k]]
        a[:, [k, at]] = a[:, [at, k]]
        order[[k, at]] = order[[at, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of pairs without a common column."""
    players = list(range(n)) + ([-1] if n % 2 else [])
    half, out = len(players) // 2, []
    for _ in range(len(players) - 1):
        pairs = [(p, q) for p, q in zip(players[:half], reversed(players[half:]), strict=True) if p >= 0 and q >= 0]
        out.append(tuple(np.array(side, np.int64) for side in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2)
        players = [players[0], players[-1], *players[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated until they are orthogonal to each other."""
    u = factor.copy()
    rounds = _rounds(u.shape[1]) if u.shape[1] > 1 else []
    tolerance = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        rotated = False
        for p, q in rounds:
            a, b = u[:, p], u[:, q]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            turn = np.abs(gamma) > tolerance * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            rotated = True
            p, q, a, b = p[turn], q[turn], a[:, turn], b[:, turn]
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            u[:, p], u[:, q] = c * a - s * b, s * a + c * b
        if not rotated:
            break
    return u


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a positive semidefinite matrix, zero eigenvalues left out."""
    factor, order = pivoted_cholesky(matrix)
    rotated = one_sided_jacobi(factor)
    values = (rotated * rotated).sum(axis=0)
    vectors = np.zeros_like(rotated)
    vectors[order] = rotated / np.sqrt(values)
    by = np.argsort(-values, kind="stable")
    values, vectors = values[by], vectors[:, by]
    at = np.argmax(np.abs(vectors), axis=0)
    return values, vectors * np.where(vectors[at, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


# --- the operator --------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: whitened = (x - mean) @ weights."""

    centre: Centre
    values: np.ndarray  # eigenvalues of the covariance, those asked for
    vectors: np.ndarray  # a column each
    trace: float
    length: int
    identity_error: float

    @property
    def weights(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(fit_list: DataFrame, length: int, n: int, spec: WhiteningSpec) -> Whitening:
    """``fit_list`` has each distinct vector of this length once; n is how many there are."""
    if n == 0:
        return Whitening(Centre(0, []), np.zeros(0), np.zeros((length, 0)), 0.0, length, 0.0)
    # Sums of halves: neither can leave 64 bits within a batch.
    low = (1 << 32) - 1
    halves = _per_task(
        fit_list, lambda x: np.stack(((x >> 32).sum(axis=0), (x & low).sum(axis=0))).astype(object), int
    )
    centre = Centre(n, [(high << 32) + rest for high, rest in zip(halves[:length], halves[length:], strict=True)])

    def scatter(x: np.ndarray) -> np.ndarray:
        z = centre.centred(x)
        return z.T @ z

    covariance = np.array(_per_task(fit_list, scatter, float)).reshape(length, length) / n
    trace = float(np.trace(covariance))
    values, vectors = eigen(covariance)
    values, vectors = values[: spec.components], vectors[:, : spec.components]
    k = len(values)
    if not k:
        return Whitening(centre, values, vectors, trace, length, 0.0)
    weights = vectors / np.sqrt(values)
    mean = np.array(_per_task(fit_list, lambda x: (centre.centred(x) @ weights).sum(axis=0), float)) / n

    def judged(x: np.ndarray) -> np.ndarray:
        w = centre.centred(x) @ weights - mean
        return w.T @ w

    found = np.array(_per_task(fit_list, judged, float)).reshape(k, k) / n
    return Whitening(centre, values, vectors, trace, length, float(np.abs(found - np.eye(k)).max()))


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """A row per vector (as ``packed_vectors`` gives them) and component."""
    k, weights, centre = len(model.values), model.weights, model.centre
    explained = model.values / model.trace if k else model.values

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, BATCH):
                batch = whole.slice(begin, BATCH)
                x = unpack_vectors(batch.column("vector").to_pylist())
                m = len(x)
                again = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(again),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, centre.n)),
                        pa.array(centre.deviations(x), pa.int64()).take(again),
                        pa.array((centre.centred(x) @ weights).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, model.identity_error)),
                    ],
                    [c.split()[0] for c in WHITENED.split(", ")],
                )

    rows = rows.filter(F.lit(k > 0) & (F.col("length") == model.length))
    return rows.select("vec_id", "vector").mapInArrow(each, WHITENED)


def whiten(spark: SparkSession, vectors: DataFrame, spec: WhiteningSpec | None = None) -> DataFrame:
    spec = spec or WhiteningSpec()
    rows = written(spark, packed_vectors(vectors, spec))
    fit_list = written(spark, rows.select("length", "vector").distinct())
    held = fit_list.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    length, n = (held["length"], held["count"]) if held else (1, 0)
    return apply(rows, fit(fit_list.filter(F.col("length") == length), length, n, spec))
