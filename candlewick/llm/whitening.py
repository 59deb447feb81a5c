"""Whitening of embeddings by incremental eigendecomposition.

Every partition starts from an empty spectrum and takes in its vectors one after
another: the centred difference from the running mean is a rank-one change of
the scatter matrix, whose new eigenvalues are the roots of a secular equation
and whose eigenvectors follow from them (with deflation where an entry vanishes
or eigenvalues meet). Spectra of partitions are combined in groups, one's
eigenpairs being rank-one changes of the other, until one is left. Its basis then
goes through a Rayleigh-Ritz step: the exact covariance, gathered from integer
differences over all rows, is projected on the basis on the executors, and the
small projected problem gives the components to double precision.

Vectors are put on an integer grid, ``floor(scale * c) + offset``. What leaves a
task is one spectrum of d by d numbers; what reaches the driver is one of those.

Defined results: a null vector, and one with a null, NaN or infinite entry, is left
out, as is one whose length isn't the most frequent among the others (of equally
frequent ones the largest). Repeated vectors and ids count each time. Without any
vector there are no rows. A component without variance (one vector, equal vectors)
has null for ``whitened`` and is left out of ``identity_error``; ``explained`` is null
if nothing varies. ``deviation`` is null where it is beyond a long; its
exact value is always in ``deviation_exact`` (decimal, null beyond 38 digits).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import stage

#: Spectra that one task combines at a time.
FAN_IN = 32
EPS = float(np.finfo(float).eps)
LONGEST = np.iinfo(np.int64).max


@np.errstate(divide="ignore", invalid="ignore")
def _roots(d: np.ndarray, z2: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)), one above each of the ascending ``d``: the
    roots and the matrix [root, j] of d_j - root, exact near the poles.

    Each root is sought from its nearer pole by rational interpolation, the poles
    below and above weighted apart, inside a shrinking bracket.
    """
    k = len(d)
    top = d[-1] + z2.sum()
    above = np.append(d[1:], top)
    gap = above - d
    middle = d + gap / 2
    below_middle = 1 + (z2 / (d[None, :] - middle[:, None])).sum(1) >= 0
    below_middle[-1] = True
    origin = np.where(below_middle, d, above)
    poles = d[None, :] - origin[:, None]
    low = np.where(below_middle, 0.0, -gap / 2)
    high = np.where(below_middle, gap / 2, 0.0)
    high[-1] = gap[-1]
    left, right = d - origin, above - origin
    lower = np.tri(k) * z2
    x, done = (low + high) / 2, np.zeros(k, bool)
    for _ in range(rounds):
        inverse = 1 / (poles - x[:, None])
        f = 1 + inverse @ z2
        inverse *= inverse
        slope = inverse @ z2
        dpsi = np.einsum("ij,ij->i", inverse, lower)
        dphi = slope - dpsi
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        d1, d2 = left - x, right - x
        c = f - d1 * dpsi - d2 * dphi
        a = (d1 + d2) * f - d1 * d2 * slope
        b = d1 * d2 * f
        disc = np.sqrt(np.abs(a * a - 4 * b * c))
        step = np.where(a <= 0, (a - disc) / (2 * c), 2 * b / (a + disc))
        # a step out of the bracket (or no number at all) becomes a bisection. The
        # steps shrink quadratically: after one of 1e-9 a root stays as it is
        new = x + step
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        last = (np.abs(step) <= 1e-9 * np.abs(x)) | (f == 0)
        x = np.where(done | (f == 0), x, np.where(last, np.clip(x + step, low, high), new))
        done |= last
        if done.all():
            break
    tiny = EPS * EPS * np.maximum(gap, np.finfo(float).tiny)
    x = np.where(x == 0, np.where(below_middle, tiny, -tiny), x)
    return origin + x, poles - x[:, None]


def add_outer(values: np.ndarray, basis: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of
    ``basis @ diag(values) @ basis.T + weight * outer(v, v)``."""
    z = basis.T @ v
    size = weight * float(z @ z)
    if not size > 0:
        return values, basis
    limit = 8 * EPS * max(abs(values[-1]), abs(values[0]), size)
    # deflation, first kind: in each run of equal eigenvalues one reflection
    # leaves a single entry of z
    close = np.diff(values) <= limit
    if close.any():
        basis = basis.copy()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], close.view(np.int8), [0]])))
        for first, last in zip(edges[::2], edges[1::2]):
            run = slice(first, last + 1)
            part = z[run]
            norm = float(np.sqrt(part @ part))
            if norm == 0:
                continue
            mirror = part.copy()
            mirror[-1] += norm if mirror[-1] >= 0 else -norm
            turned = -norm if part[-1] >= 0 else norm
            basis[:, run] -= np.outer(basis[:, run] @ mirror, mirror) * (2 / float(mirror @ mirror))
            z[run] = 0
            z[last] = turned
    # second kind: entries of z that change nothing
    kept = weight * np.sqrt(float(z @ z)) * np.abs(z) > limit
    k = int(kept.sum())
    if k == 0:
        return values, basis
    whole = k == len(values)
    d, zk = (values, z) if whole else (values[kept], z[kept])
    roots, gaps = _roots(d, weight * zk * zk)
    # the z for which these roots are exact (products over the interlacing gaps)
    between = d[:, None] - d[None, :]
    after = np.vstack([between[1:], np.ones((1, k))])
    strictly = np.tri(k, k, -1, dtype=bool).T
    fit = np.sqrt(np.abs(np.prod(-gaps / np.where(strictly, between, after), axis=0))) * np.sign(zk)
    turn = (fit[None, :] / gaps).T
    turn /= np.sqrt((turn * turn).sum(0))
    if whole:
        return roots, basis @ turn
    values, basis = values.copy(), basis.copy() if not close.any() else basis
    values[kept] = roots
    basis[:, kept] = basis[:, kept] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Count, mean and eigendecomposed scatter matrix of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @staticmethod
    def empty(d: int) -> Spectrum:
        return Spectrum(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, vector: np.ndarray, copies: int = 1) -> None:
        """One vector, ``copies`` times."""
        delta = vector - self.mean
        weight = self.n * copies / (self.n + copies)
        self.n += copies
        self.mean = self.mean + delta * (copies / self.n)
        if weight:
            self.values, self.basis = add_outer(self.values, self.basis, delta, weight)

    def merge(self, other: Spectrum) -> None:
        """The other's vectors as well, by its eigenpairs."""
        if other.n == 0:
            return
        delta = other.mean - self.mean
        weight = self.n * other.n / (self.n + other.n)
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = add_outer(self.values, self.basis, vector, float(value))
        if weight:
            self.values, self.basis = add_outer(self.values, self.basis, delta, weight)
        self.mean = self.mean + delta * (other.n / (self.n + other.n))
        self.n += other.n

    def pack(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.basis.ravel()]).astype("<f8").tobytes()

    @staticmethod
    def unpack(raw: bytes) -> Spectrum:
        x = np.frombuffer(raw, "<f8").copy()
        d = int(round(np.sqrt(len(x)))) - 1  # 1 + 2 d + d * d numbers
        return Spectrum(int(x[0]), x[1 : d + 1], x[d + 1 : 2 * d + 1], x[2 * d + 1 :].reshape(d, d))


def usable(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Rows whose vector has only finite entries and the most frequent length, and
    that length (0 without any)."""
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    good = df.filter(F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, number))
    common = good.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    return good.filter(F.size(column) == d), d


def _grid(batch: pa.RecordBatch, column: str, d: int, scale: float, offset: int) -> np.ndarray:
    """The vectors of a batch as integers, one a row."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(-1, d) + offset


def _fold(spark: SparkSession, parts: DataFrame, merge, name: str) -> bytes | None:
    """Combine ``(part long, body binary)`` in groups of FAN_IN neighbours, round
    by round on the executors, to one body. Rounds are staged tables."""
    parts = stage(spark, parts, name)
    n = parts.count()
    while n > 1:
        def combine(table: pa.Table) -> pa.Table:
            rows = sorted(zip(table.column("part").to_pylist(), table.column("body").to_pylist()))
            return pa.table({"part": pa.array([rows[0][0] // FAN_IN], pa.int64()), "body": [merge([b for _, b in rows])]})

        parts = stage(
            spark, parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(combine, "part long, body binary"), name
        )
        n = parts.count()
    row = parts.first()
    return bytes(row["body"]) if row else None


def _merge_spectra(bodies: list[bytes]) -> bytes:
    first, *rest = map(Spectrum.unpack, bodies)
    for other in rest:
        first.merge(other)
    return first.pack()


def _add_arrays(bodies: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(b, "<f8") for b in bodies], axis=0).astype("<f8").tobytes()


@dataclass
class Whitening:
    n: int
    sums: list[int]  # of the grid vectors, by dimension
    values: np.ndarray  # variances along the components, falling
    components: np.ndarray  # columns
    trace: float
    identity_error: float
    scale: float
    offset: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Grid vectors less their mean; the integer difference is exact."""
        return (self.n * x - np.array(self.sums, np.int64)) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """One column a component; NaN where the component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (self.centred(x) @ self.components) / np.sqrt(self.values)
        return np.where(self.varies(), out, np.nan)

    def varies(self) -> np.ndarray:
        return self.values > 1e-12 * max(self.trace, 0.0)


def fit(
    spark: SparkSession, vectors: DataFrame, column: str = "embedding", components: int = 8,
    scale: float = 1024.0, offset: int = 100_000,
) -> Whitening | None:
    """Components of all usable vectors; None without any."""
    rows, d = usable(vectors.select(column), column)
    if d == 0:
        return None

    def gather(batches):
        """Per partition: exact sums and the spectrum after its rank-one updates."""
        spectrum, sums = Spectrum.empty(d), np.zeros(d, np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _grid(batch, column, d, scale, offset)
            sums += x.sum(0)
            # copies inside a batch are one update
            _, at, copies = np.unique(x, axis=0, return_index=True, return_counts=True)
            for i, c in zip(at.tolist(), copies.tolist()):
                spectrum.add((x[i] - offset).astype(np.float64), c)
        if spectrum.n:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "sums": pa.array([sums.tolist()], pa.list_(pa.int64())), "n": pa.array([spectrum.n], pa.int64()),
                "body": pa.array([spectrum.pack()], pa.binary()),
            })

    parts = stage(spark, rows.mapInArrow(gather, "part long, sums array<long>, n long, body binary"), "whitening-parts")
    # exact totals: one row for each dimension
    totals = parts.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")
    ).orderBy("at").collect()
    n, sums = int(totals[0]["n"]), [int(r["s"]) for r in totals]
    start = Spectrum.unpack(_fold(spark, parts.select("part", "body"), _merge_spectra, "whitening-spectra"))
    basis, _ = np.linalg.qr(start.basis)

    # Rayleigh-Ritz: the exact covariance seen from the basis
    model = Whitening(n, sums, np.zeros(0), basis, 0.0, 0.0, scale, offset)
    projected = _gram(spark, rows, column, d, model, lambda m, x: m.centred(x) @ m.components)
    small = projected.reshape(d, d) / n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")[: min(components, d)]
    model = Whitening(
        n, sums, np.maximum(values[order], 0.0), basis @ turn[:, order], float(np.trace(small)), 0.0, scale, offset
    )
    if model.varies().any():
        k = len(order)
        seen = _gram(spark, rows, column, d, model, lambda m, x: np.nan_to_num(m.whiten(x))).reshape(k, k) / n
        keep = np.flatnonzero(model.varies())
        model.identity_error = float(np.abs(seen[np.ix_(keep, keep)] - np.eye(len(keep))).max())
    return model


def _gram(spark: SparkSession, rows: DataFrame, column: str, d: int, model: Whitening, look) -> np.ndarray:
    """Sum over all rows of outer(y, y), y = look(model, vector), as a flat array;
    ``look`` gives vectors that are centred."""
    held = spark.sparkContext.broadcast(model)

    def gather(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = look(held.value, _grid(batch, column, d, model.scale, model.offset))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "body": pa.array([total.astype("<f8").tobytes()], pa.binary()),
            })

    body = _fold(spark, rows.mapInArrow(gather, "part long, body binary"), _add_arrays, "whitening-gram")
    return np.frombuffer(body, "<f8")


def _exact_squares(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n x - S)^2 as Python integers."""
    diff = n * x - np.array(sums, np.int64)
    top = int(np.abs(diff).max(initial=0))
    if top * top * max(1, x.shape[1]) <= LONGEST:
        return (diff * diff).sum(1).tolist()
    return [sum(v * v for v in row) for row in diff.tolist()]


def transform(spark: SparkSession, vectors: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """All columns of ``vectors`` for each usable row, plus ``deviation``,
    ``deviation_exact`` and ``whitened``, an array with an entry for each component
    (columns of those names are replaced)."""
    names = ["deviation", "deviation_exact", "whitened"]
    rest = vectors.drop(*[c for c in names if c != column])
    fields = "deviation long, deviation_exact decimal(38,0), whitened array<double>"
    schema = T.StructType(rest.schema.fields + T._parse_datatype_string(fields).fields)
    if model is None:
        return spark.createDataFrame([], schema)
    d = len(model.sums)
    rows, most = usable(rest, column)
    if most != d:  # other vectors than the model's: only those that fit
        rows = rest.filter(F.size(column) == d)
        rows = rows.filter(F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    held = spark.sparkContext.broadcast(model)

    def look(batches):
        m = held.value
        for batch in batches:
            x = _grid(batch, column, d, m.scale, m.offset)
            w = m.whiten(x)
            squares = _exact_squares(x, m.n, m.sums)
            flat = pa.array(w.ravel(), mask=np.isnan(w).ravel())
            offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            new = [
                pa.array([s if s <= LONGEST else None for s in squares], pa.int64()),
                pa.array([Decimal(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(offsets, flat),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    return rows.mapInArrow(look, schema)


def report(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """One row for each usable vector and component, numbered from 1."""
    model = fit(spark, vectors.select(column), column, components)
    rows = transform(spark, vectors.select(key, column), model, column)
    if model is None:
        model = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, 1.0, 0)
    share = F.array(*[
        F.lit(float(v / model.trace) if model.trace > 0 else None).cast("double") for v in model.values
    ]) if len(model.values) else F.array(F.lit(None).cast("double"))
    return rows.select(
        key, "deviation", "deviation_exact", F.posexplode("whitened").alias("__at", "whitened")
    ).select(
        key, (F.col("__at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(share, F.col("__at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"), "deviation_exact",
    )
