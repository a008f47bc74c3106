"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers x = floor(64 c) + 1000000 (built-in functions), so
counts, sums and deviations are exact. The covariance V is that of the
distinct integer vectors (the fit list, written once), divisor n.

1. One pass counts the fit list and sums every dimension exactly.
2. V is never formed from uncentred products. A pass multiplies it with a
   block Q: every task centres its vectors, y = (n x - S) / n, adds up
   Y'(Y Q) and yields one row per dimension; the rows are summed by dimension
   and only a (dimensions x block) matrix reaches the driver.
3. The block has ``guard`` more columns than components are asked for. Its
   smallest Ritz value bounds the unwanted spectrum, [0, bound] as V has no
   negative eigenvalue. A three-term Chebyshev recurrence of such passes
   damps that interval and lifts what lies above it; QR, then Rayleigh-Ritz.
4. This repeats until every wanted pair is certified: the residual
   |V q - e q| is below ``tolerance`` times the largest eigenvalue. A run that
   is not certified within ``max_rounds`` raises ``RuntimeError``. A block as
   wide as the space is certified by its first Rayleigh-Ritz.
5. A last pass over the fit list measures the whitened covariance, one map
   over all rows whitens them.

Rows whose vector is null or holds null, NaN or infinite entries are left
out, as are vectors whose length is not the most common one (of equally
common lengths the larger) and empty vectors. Repeated rows are all whitened but fitted
once. Null ids are kept; other columns are ignored. Components whose
eigenvalue is below 1e-12 of the trace cannot be whitened and are left out:
a table of one distinct vector, or of none, gives no rows. A deviation that a
long cannot hold is null. Entries beyond 2**56 raise an arithmetic error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import textbuf as tb
from cairn.session import cut_lineage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS, GUARD = 16, 32
DEGREE = 16
TOLERANCE = 1e-13
MAX_ROUNDS = 60
LEAST = 1e-12  # of the trace: smaller eigenvalues count as none


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray  # exact, per dimension
    vectors: np.ndarray  # columns: unit eigenvectors by falling eigenvalue
    values: np.ndarray
    trace: float
    identity_error: float
    rounds: int
    passes: int


def integer_rows(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows whose vector is whole, finite and of the usual length."""
    c = embeddings.select(embeddings[id_col].alias("id"), embeddings[vector_col].cast("array<double>").alias("v"))
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    c = c.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
    usual = c.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    c = c.where(F.size("v") == (usual["size"] if usual else 0))
    return c.select("id", F.transform("v", lambda e: F.floor(e * SCALE) + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a batch, one a row."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _summed(fit: DataFrame, part, rows: int, width: int, kind: str) -> np.ndarray:
    """Sum over all tasks of the (rows x width) matrices that ``part`` makes
    of a batch's vectors: one row per matrix row and task is shuffled."""
    dtype = np.int64 if kind == "long" else np.float64
    names = [f"s{j}" for j in range(width)]

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                made = part(_matrix(batch.column(0)))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rows, dtype=np.int32)), *(pa.array(np.ascontiguousarray(total[:, j], dtype)) for j in range(width))],
                names=["i", *names],
            )

    parts = fit.select("x").mapInArrow(run, ", ".join(["i int", *(f"{s} {kind}" for s in names)]))
    out = np.zeros((rows, width), dtype)
    for row in parts.groupBy("i").agg(*(F.sum(s).alias(s) for s in names)).collect():  # at most `rows` rows
        out[row["i"]] = row[1:]
    return out


def exact_sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Vectors of the fit list and exact sums per dimension."""
    head = fit.first()
    if head is None:
        return 0, np.zeros(0, np.int64)
    d = len(head["x"])
    found = _summed(fit, lambda x: np.stack([x.sum(axis=0), np.full(d, len(x))], axis=1), d, 2, "long")
    return int(found[0, 1]), found[:, 0]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def _steps(top: float, wanted: float, bound: float, degree: int) -> int:
    """Degree of the filter: as asked, but so low that the largest
    eigenvector does not drown the smallest wanted one."""
    half = bound / 2
    if half <= 0:
        return 1
    grow = lambda e: np.arccosh(max(1.0, (e - half) / half))
    spread = grow(top) - grow(wanted)
    return max(2, min(degree, int(np.log(1e8) / spread))) if spread > 0 else degree


def fit(rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE,
        max_rounds: int = MAX_ROUNDS, seed: int = 13) -> Whitening | None:
    """Certified whitening of the distinct vectors of ``rows`` (x); None when
    there is nothing to whiten."""
    distinct = cut_lineage(rows.select("x").distinct(), "whitening_fit")
    n, sums = exact_sums(distinct)
    if n < 2:
        return None
    d = len(sums)
    width = min(d, components + guard)
    passes = 0

    def times(q: np.ndarray) -> tuple[np.ndarray, float]:
        """V q and the trace of V."""
        nonlocal passes
        passes += 1

        def part(x):
            y = centred(x, n, sums)
            return np.concatenate([y.T @ (y @ q), (y * y).sum(axis=0)[:, None]], axis=1)

        found = _summed(distinct, part, d, q.shape[1] + 1, "double")
        return found[:, :-1] / n, float(found[:, -1].sum() / n)

    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))
    wanted = min(components, d)
    for done in range(max_rounds + 1):
        vq, trace = times(q)
        if trace == 0.0:
            return None
        # Rayleigh-Ritz
        h = q.T @ vq
        values, u = np.linalg.eigh((h + h.T) / 2)
        values, u = values[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        if residual.max() <= tolerance * values[0] or width == d:
            break
        # Chebyshev filter: T_m of V mapped so that [0, bound] becomes [-1, 1]
        half = max(values[-1], 1e-9 * values[0]) / 2
        first = sigma = half / (values[0] - half)
        last, now = q, (vq - half * q) * (sigma / half)
        for _ in range(_steps(values[0], values[wanted - 1], 2 * half, degree) - 1):
            following = 1 / (2 / first - sigma)
            product, _ = times(now)
            last, now = now, (2 * following / half) * (product - half * now) - sigma * following * last
            sigma = following
        q, _ = np.linalg.qr(now)
    else:
        raise RuntimeError(f"not certified after {max_rounds} rounds: residual {residual.max():.2e} of {values[0]:.2e}")

    good = int((values[:wanted] > LEAST * trace).sum())
    q, values = q[:, :good], values[:good]
    top = np.abs(q).argmax(axis=0)
    q = q * np.sign(q[top, np.arange(good)])

    scaled = q / np.sqrt(values)

    def spread(x):
        z = centred(x, n, sums) @ scaled
        return np.concatenate([z.T @ z, z.sum(axis=0)[:, None]], axis=1)

    moments = _summed(distinct, spread, good, good + 1, "double") / n
    covariance = moments[:, :-1] - np.outer(moments[:, -1], moments[:, -1])
    error = float(np.abs(covariance - np.eye(good)).max())
    return Whitening(n, sums, q, values, trace, error, done, passes)


RESULT = "id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per row of ``rows`` and component."""
    schema = RESULT.format(rows.schema["id"].dataType.simpleString())
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, sums, scaled = model.n, model.sums, model.vectors / np.sqrt(model.values)
    p = scaled.shape[1]
    explained, error = model.values / model.trace, model.identity_error

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            off = n * _matrix(tb.column(batch, "x")) - sums
            too_big = (off.astype(np.float64) ** 2).sum(axis=1) >= 2.0**63 * (1 - 1e-9)
            deviation = pa.array((off * off).sum(axis=1), mask=too_big)
            each = pa.array(np.repeat(np.arange(m), p))
            yield pa.RecordBatch.from_arrays(
                [
                    tb.column(batch, "id").take(each),
                    pa.array(np.tile(np.arange(1, p + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * p, n)),
                    deviation.take(each),
                    pa.array(((off / n) @ scaled).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * p, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
