"""Whitening of vectors by QDWH spectral divide-and-conquer of their covariance.

Spark does what grows with the rows: exact integer sums, the centred covariance (one
d x d partial sum per task), and the projection of every row. The d x d eigenproblem,
whose size is the vectors' dimension and nothing else, is solved on the driver:

* the polar factor U of V - s*I comes from QR-based dynamically weighted Halley
  iterations (QDWH), without forming an inverse;
* (U + I) / 2 is the projector on the invariant subspace of eigenvalues above s;
  its range and null space, from a QR factorisation after subspace iteration,
  split V into two smaller blocks;
* blocks are split again until they are single components. Only blocks that
  hold wanted components are followed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.vectors import dimension, matrix, usable

EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QR-based QDWH iterations."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low = EPS  # a lower bound of the least singular value; too low only costs an iteration
    for _ in range(20):
        q = low * low
        e = np.cbrt(4 * (1 - q) / (q * q))
        h = np.sqrt(1 + e) + 0.5 * np.sqrt(8 - 4 * e + 8 * (2 - q) / (q * np.sqrt(1 + e)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        basis = np.linalg.qr(np.concatenate([np.sqrt(c) * x, np.eye(n)]))[0]
        new = (b / c) * x + (h - b / c) / np.sqrt(c) * (basis[:n] @ basis[n:].T)
        low = min(1.0, low * (h + b * q) / (1 + c * q))
        moved = np.linalg.norm(new - x)
        x = (new + new.T) / 2
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def _split(v: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k vectors span the eigenvectors above some shift; None if
    all eigenvalues of ``v`` are equal to working precision."""
    n, mean = len(v), np.trace(v) / len(v)
    spread = np.linalg.norm(v - mean * np.eye(n)) / np.sqrt(n)
    size = np.linalg.norm(v)
    if spread <= 4 * EPS * size:
        return None
    best = None
    for shift in (np.median(np.diag(v)), mean, *(mean + f * spread for f in (0.3, -0.3, 0.7, -0.7, 0.11, -0.11))):
        projector = (polar(v - shift * np.eye(n)) + np.eye(n)) / 2
        k = round(np.trace(projector))
        if not 0 < k < n:
            continue
        start = projector[:, np.argsort(-np.linalg.norm(projector, axis=0), kind="stable")[:k]]
        start = projector @ (start + 1e-3 * projector @ np.random.default_rng(n).normal(size=(n, k)))
        basis = np.linalg.qr(start, mode="complete")[0]
        basis = np.linalg.qr(projector @ basis[:, :k], mode="complete")[0]
        rest = np.linalg.norm(basis[:, k:].T @ v @ basis[:, :k]) / size
        if best is None or rest < best[2]:
            best = basis, k, rest
        if rest <= 100 * n * EPS:
            break
    return best and best[:2]


def leading_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    n = len(v)
    if not n or not wanted:
        return np.zeros(0), np.zeros((n, 0))
    found, work = [], [(np.eye(n), min(wanted, n))]
    while work:
        q, need = work.pop()
        block = q.T @ v @ q
        block = (block + block.T) / 2
        cut = _split(block) if len(block) > 1 else None
        if cut is None:
            found.append(q[:, :need])
            continue
        basis, k = cut
        work.append((q @ basis[:, :k], min(need, k)))
        if need > k:
            work.append((q @ basis[:, k:], need - k))
    q = np.concatenate(found, axis=1)
    values = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-values, kind="stable")
    values, q = values[order], q[:, order] / np.linalg.norm(q[:, order], axis=0)
    signs = np.sign(q[np.abs(q).argmax(axis=0), np.arange(q.shape[1])])
    return values, q * signs


def _longs(lists: pa.Array, d: int, scale: int, offset: int) -> np.ndarray:
    x = np.floor(matrix(lists, d) * scale)
    if x.size and np.abs(x).max() > 2.0**52:
        raise ValueError("a scaled component is beyond 2^52")
    return x.astype(np.int64) + offset


def _exact_squares(y: np.ndarray) -> list[int]:
    """Sums of squares by row, as Python integers where 64 bits might not hold them."""
    if not y.size or int(np.abs(y).max()) ** 2 * y.shape[1] < 2**63:
        return (y * y).sum(axis=1).tolist()
    return (y.astype(object) ** 2).sum(axis=1).tolist()


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    A component x of a vector becomes floor(scale * x) + offset. n, S: number and sums of these
    integer vectors; deviation, decimal(38,0): the exact sum over dimensions of (n*x - S)^2;
    whitened: x - S/n projected on the component (a unit eigenvector of the covariance,
    numbered from 1 by falling eigenvalue e; its largest entry is positive) over sqrt(e);
    explained: e over the trace; identity_error: the largest absolute entry of the covariance
    of all whitened rows, as they come out, minus the identity.

    Rows whose vector is null or holds a null, NaN or infinite component are left out. Shorter
    vectors count as ending in zeros. Repeated rows count as often as they are there; a null id
    stays null. A component without variance (e within rounding of 0: one row, equal rows,
    constant dimensions) has a null whitened value, and without any variance at all explained
    and identity_error are null as well. Other columns are ignored; no rows, or only empty
    vectors, give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    d = dimension(rows, "vector")
    ids = rows.schema["id"].dataType.simpleString()

    def sums(batches):
        n, total = 0, np.zeros(d, np.int64)
        for b in batches:
            n += b.num_rows
            total += _longs(b.column("vector"), d, scale, offset).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(d + 1)), "s": pa.array(np.append(total, n))})

    summed = dict(rows.mapInArrow(sums, "i long, s long").groupBy("i").agg(F.sum("s")).collect()) if d else {}
    n, s = summed.get(d, 0), np.array([summed.get(i, 0) for i in range(d)], np.int64)
    mean = s / n if n else s

    def products(of):
        """Partial sums of the outer products of ``of(integers)``: the upper triangle's rows."""
        def run(batches):
            total = None
            for b in batches:
                y = of(_longs(b.column("vector"), d, scale, offset))
                total = y.T @ y if total is None else total + y.T @ y
            if total is not None:
                upper = np.triu_indices(len(total))
                yield pa.RecordBatch.from_pydict({
                    "i": pa.array(upper[0]), "j": pa.array(upper[1]), "v": pa.array(total[upper])})
        return run

    def covariance(of, size):
        v = np.zeros((size, size))
        if n:
            parts = rows.mapInArrow(products(of), "i long, j long, v double").groupBy("i", "j").agg(F.sum("v"))
            for i, j, x in parts.collect():
                v[i, j] = v[j, i] = x / n
        return v

    v = covariance(lambda x: x - mean, d)
    values, axes = leading_components(v, components)
    trace = float(np.trace(v))
    real = values > d * EPS * max(trace, 0.0)
    weights = axes / np.sqrt(np.where(real, values, 1.0))
    error = None
    if real.any():
        of_all = covariance(lambda x: (x - mean) @ weights[:, real], int(real.sum()))
        error = float(np.abs(of_all - np.eye(len(of_all))).max())
    shares = (values / trace).tolist() if trace > 0 else [None] * len(values)

    def project(batches):
        for whole in batches:
            for o in range(0, whole.num_rows, 4096):
                b = whole.slice(o, 4096)
                x = _longs(b.column("vector"), d, scale, offset)
                out = (x - mean) @ weights
                squares = _exact_squares(x * n - s)
                k = len(values)
                yield pa.RecordBatch.from_arrays([
                    b.column("id").take(pa.array(np.repeat(np.arange(b.num_rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                    pa.array(np.full(b.num_rows * k, n)),
                    pa.array(squares, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(b.num_rows), k))),
                    pa.array(out.reshape(-1), mask=np.tile(~real, b.num_rows)),
                    pa.array(shares * b.num_rows, pa.float64()),
                    pa.array([error] * (b.num_rows * k), pa.float64())],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = f"id {ids}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    found = rows.mapInArrow(project, out) if len(values) else spark.createDataFrame([], out)
    return found.withColumnRenamed("id", id_col)
