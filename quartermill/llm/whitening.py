"""Whitening of embeddings by an incremental eigendecomposition.

Every partition of the fit list (each distinct vector once) takes its rows one by one:
the scatter matrix around the running mean changes by one centred outer product, so
its spectrum changes by a rank-one update. That is the secular equation, solved for
all roots at once, after components that the update leaves alone are deflated. Spectra
of partitions are combined in a tree, where each eigenpair of the one is a rank-one
update of the other and the difference of the means is one more. The vectors found
span the space of a last distributed Rayleigh-Ritz step, which sums the centred
covariance in that basis over all rows and so takes the rounding of the updates out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermill.llm.common import ensure_checkpoint_dir, list_array, quoted

EPS = np.finfo(float).eps
#: Spectra that meet in one task of the tree.
FAN = 16
SCALE, SHIFT = 64, 1_000_000


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z', ``d`` rising and no ``z2`` (squares of z) zero.

    Returns the matrix root[i] - d[j], without cancellation, and the roots. Each root
    is found from the nearer pole by rational interpolation between its two poles,
    within a bracket that is halved whenever a step would leave it.
    """
    k = len(d)
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    gap = upper - d
    # The nearer pole of each root is its origin.
    middle = d + gap / 2
    at_middle = 1 + rho * (z2 / (d[None, :] - middle[:, None])).sum(1)
    right = at_middle < 0
    right[-1] = False
    origin = np.where(right, upper, d)
    delta = d[None, :] - origin[:, None]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    high[-1] = gap[-1]
    low[-1], high[-1] = (gap[-1] / 2, gap[-1]) if at_middle[-1] < 0 else (0.0, gap[-1] / 2)
    left_pole, right_pole = np.where(right, -gap, 0.0), np.where(right, 0.0, gap)
    tau = (low + high) / 2
    lower = np.tri(k)
    weights = rho * z2
    live, found = np.arange(k), tau.copy()
    poles = delta
    for _ in range(80):
        inverse = 1 / (poles - tau[:, None])
        terms = weights * inverse
        slopes = terms * inverse
        f, slope = 1 + terms.sum(1), slopes.sum(1)
        psi = np.einsum("ij,ij->i", slopes, lower)
        phi = slope - psi
        below = f < 0
        low, high = np.where(below, tau, low), np.where(below, high, tau)
        a1, a2 = left_pole - tau, right_pole - tau
        a = (a1 + a2) * f - a1 * a2 * slope
        b = a1 * a2 * f
        c = f - a1 * psi - a2 * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            new = tau + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        still = (np.abs(new - tau) > 2 * EPS * np.abs(new)) & (np.abs(f) > EPS * k * (1 + np.abs(terms).sum(1)))
        found[live] = np.where(still, new, tau)
        if not still.any():
            break
        live, tau, low, high, poles, lower = live[still], new[still], low[still], high[still], poles[still], lower[still]
        left_pole, right_pole = left_pole[still], right_pole[still]
    tau = found
    return tau[:, None] - delta, origin + tau


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of V diag(values) V' + rho v v', with ``values`` rising and ``rho`` positive."""
    z = vectors.T @ v
    size = float(z @ z)
    scale = max(abs(values[-1]), abs(values[0]), rho * size)
    if not scale or rho * size <= EPS * EPS * scale:
        return values, vectors
    tolerance = 8 * EPS * scale
    small = rho * np.abs(z) * np.sqrt(size) <= tolerance
    close = np.flatnonzero(np.diff(values) <= tolerance)
    if len(close):
        # Of two values that are as good as equal, turn one's share of the update into the other.
        vectors, values = vectors.copy(), values.copy()
        for i in close.tolist():
            r = np.hypot(z[i], z[i + 1])
            if r > 0:
                c, s = z[i + 1] / r, z[i] / r
                one, two = vectors[:, i].copy(), vectors[:, i + 1].copy()
                vectors[:, i], vectors[:, i + 1] = c * one - s * two, s * one + c * two
                p, q = values[i], values[i + 1]
                values[i], values[i + 1] = c * c * p + s * s * q, s * s * p + c * c * q
                z[i], z[i + 1] = 0.0, r
                small[i], small[i + 1] = True, rho * r * np.sqrt(size) <= tolerance
    live = np.flatnonzero(~small)
    if not len(live):
        return values, vectors
    d, zl = values[live], z[live]
    rise = np.argsort(d, kind="stable")
    live, d, zl = live[rise], d[rise], zl[rise]
    k = len(d)
    above, roots = secular_roots(d, zl * zl, rho)  # above[i, j] = root i less pole j
    # The vector whose update has exactly these roots; with it the eigenvectors are orthogonal.
    i, j = np.arange(k)[:, None], np.arange(k)[None, :]
    poles = np.where(i < j, d[:, None] - d[None, :], np.append(d[1:], 0)[:, None] - d[None, :])
    poles[-1, :] = 1.0
    exact = np.abs(above / poles).prod(0) / rho
    zh = np.copysign(np.sqrt(exact), zl)
    turned = -(zh[:, None] / above.T)
    turned /= np.sqrt((turned * turned).sum(0))
    values, vectors = values.copy(), vectors.copy()
    vectors[:, live] = vectors[:, live] @ turned
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean and eigenpairs of the scatter matrix of some rows."""

    def __init__(self, d: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(d), np.zeros(d), np.eye(d)

    def add(self, row: np.ndarray) -> None:
        """One more row: a centred rank-one update."""
        self.n += 1
        off = row - self.mean
        self.mean += off / self.n
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, (self.n - 1) / self.n, off)

    def merge(self, other: Spectrum) -> None:
        """All rows of another spectrum."""
        if not other.n:
            return
        off, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), vector)
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / n, off)
        self.mean = self.mean + off * (other.n / n)
        self.n = n

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.n], self.mean, self.values, self.vectors.ravel()])

    @staticmethod
    def of(flat: np.ndarray, d: int) -> Spectrum:
        out = Spectrum(d)
        out.n, out.mean, out.values, out.vectors = int(flat[0]), flat[1 : d + 1].copy(), flat[d + 1 : 2 * d + 1].copy(), flat[2 * d + 1 :].reshape(d, d).copy()
        return out


def matrix_of(column: pa.Array, d: int) -> np.ndarray:
    """The rows of a list column whose lists have ``d`` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit numbers where they hold it, else Python's."""
    if len(x) and n * max(int(x.max()), -int(x.min())) + max(map(abs, sums)) >= 1 << 62:
        return x.astype(object) * n - np.array(sums, object)
    return x * np.int64(n) - np.array(sums, np.int64)


STATE = "id long, state array<double>"


def per_partition(rows: DataFrame, start: Callable, take: Callable, finish: Callable) -> DataFrame:
    """One row per partition: its number and ``finish(state)``, after ``take(state, x)`` of each batch."""
    def run(batches):
        state = start()
        for batch in batches:
            state = take(state, batch.column(0))
        flat = np.asarray(finish(state), float).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), list_array(pa.array(flat), [len(flat)])], names=["id", "state"])

    return rows.mapInArrow(run, STATE)


def in_tree(states: DataFrame, parts: int, merge: Callable) -> np.ndarray:
    """The states of all partitions merged, a few at a time; the last one is of bounded size."""
    def solve(table):
        ids = np.argsort(table.column("id").to_numpy())
        merged = merge([np.array(table.column("state")[int(k)].values) for k in ids])
        at = int(table.column("id").to_numpy().min()) // FAN
        return pa.table({"id": pa.array([at], pa.int64()), "state": list_array(pa.array(merged), [len(merged)])})

    while True:
        states = states.groupBy(F.floor(F.col("id") / FAN).alias("of")).applyInArrow(solve, STATE)
        parts = -(-parts // FAN)
        if parts <= 1:
            return np.array(states.first()["state"])


def sums_of(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their entries."""
    def run(batches):
        for batch in batches:
            column = batch.column(0)
            length = pa.compute.list_value_length(column).to_numpy()
            for d in np.unique(length).tolist():
                x = matrix_of(column.filter(pa.array(length == d)), d)
                top = max(int(x.max()), -int(x.min()))
                total = x.sum(0) if top * len(x) < 1 << 62 else [int(v) for v in x.astype(object).sum(0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([len(x)] * d, pa.int64()), pa.array(total, pa.int64())], names=["d", "k", "n", "s"])

    found = rows.mapInArrow(run, "d int, k int, n long, s long").groupBy("d", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d", "k").collect()
    if len({r["d"] for r in found}) > 1:
        raise ValueError("vectors of several lengths")
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in found]


def add(states: list[np.ndarray]) -> np.ndarray:
    return np.sum(states, axis=0)


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = 16) -> DataFrame:
    """Vectors in the units of their principal components.

    A vector that is null, empty or holds a null or non-finite entry leaves. Entries c
    become whole numbers x = floor(64 c) + 1,000,000. The model is fitted on each
    distinct x-vector once: n vectors with sums S. Adds ``n``, ``deviation`` (the exact sum
    over dimensions of (n x - S)^2), ``whitened`` (x - S / n, unrounded, projected on the
    unit eigenvectors of the covariance, by falling eigenvalue, over the roots of the
    eigenvalues), ``explained`` (shares of the trace) and ``identity_error`` (largest
    absolute entry of the whitened fit list's covariance less the identity).

    Directions without variance are no components, so there may be fewer than
    ``components``, none for a single distinct vector. Repeated rows each stay, ids play no
    part, other columns pass through, save those named like an output. A table without
    vectors gives no rows. Vectors of several lengths are an error, and so is an entry, a
    sum or a deviation that no long can hold.
    """
    spark = embeddings.sparkSession
    names = ["n", "deviation", "whitened", "explained", "identity_error"]
    out = [T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType())),
           T.StructField("explained", T.ArrayType(T.DoubleType())), T.StructField("identity_error", T.DoubleType())]
    kept = [f for f in embeddings.schema.fields if f.name.lower() not in names]
    schema = T.StructType([*kept, *out])
    c = F.col(quoted(vector))
    holds = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(c, lambda x: F.floor(x.cast("double") * SCALE) + SHIFT)
    rows = embeddings.filter(holds).select(*[F.col(quoted(f.name)).alias(f"c{k}") for k, f in enumerate(kept)], whole.alias("x"))

    folder = f"{ensure_checkpoint_dir(spark)}/whitening-{uuid.uuid4().hex}"
    rows.select("x").distinct().write.parquet(folder)
    fit = spark.read.schema("x array<long>").parquet(folder)
    n, sums = sums_of(fit)
    d, parts = len(sums), fit.rdd.getNumPartitions()
    if not n:
        return spark.createDataFrame([], schema)

    def take(state, column):
        for row in centred(matrix_of(column, d), n, sums).astype(float) / n:
            state.add(row)
        return state

    def merged(states):
        total = Spectrum.of(states[0], d)
        for state in states[1:]:
            total.merge(Spectrum.of(state, d))
        return total.flat()

    spectra = per_partition(fit, lambda: Spectrum(d), take, lambda s: s.flat())
    basis, _ = np.linalg.qr(Spectrum.of(in_tree(spectra, parts, merged), d).vectors)

    def gram(state, column):
        y = (centred(matrix_of(column, d), n, sums).astype(float) / n) @ basis
        return state + y.T @ y

    ritz = in_tree(per_partition(fit, lambda: np.zeros((d, d)), gram, lambda s: s), parts, add).reshape(d, d) / n
    values, turned = np.linalg.eigh((ritz + ritz.T) / 2)
    trace = float(np.trace(ritz))
    largest = np.argsort(-values, kind="stable")[:components]
    largest = largest[values[largest] > max(values.max(), 0.0) * d * EPS]
    values, axes = values[largest], (basis @ turned)[:, largest]
    k, projection = len(values), axes / np.sqrt(values)

    def moments(state, column):
        w = (centred(matrix_of(column, d), n, sums).astype(float) / n) @ projection
        return state + np.concatenate([w.sum(0), (w.T @ w).ravel()])

    total = in_tree(per_partition(fit, lambda: np.zeros(k + k * k), moments, lambda s: s), parts, add) / n if k else np.zeros(0)
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    error = float(np.abs(covariance - np.eye(k)).max()) if k else 0.0
    shares, width = values / trace if k else values, len(kept)

    def run(batches):
        for batch in batches:
            off = centred(matrix_of(batch.column(width), d), n, sums)
            square = off.astype(float)
            if (square * square).sum(1).max(initial=0) >= 2.0**62:
                deviation = [int(v) for v in (off.astype(object) ** 2).sum(1)]
            else:
                deviation = (off * off).sum(1)
            many = len(off)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array([n] * many, pa.int64()), pa.array(deviation, pa.int64()),
                 list_array(pa.array(((square / n) @ projection).ravel()), [k] * many), list_array(pa.array(np.tile(shares, many)), [k] * many),
                 pa.array([error] * many, pa.float64())],
                names=schema.names)

    return rows.mapInArrow(run, schema)
