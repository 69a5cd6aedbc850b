"""Embedding whitening: principal components by QDWH spectral divide-and-conquer, applied as a broadcast matrix.

1. One pass counts the vectors and sums every dimension exactly (integers). A second pass adds up products of the
   vectors centred at the rounded mean; these are integers too, so the covariance does not depend on how rows are dealt
   to tasks. The remaining shift (under one half in each dimension) is taken off at the end.
2. The covariance (dimensions x dimensions, the only thing that reaches the driver) is split recursively. The polar
   factor of ``A - shift * I``, by the QR-based, dynamically weighted Halley iteration (QDWH), is +1 on the eigenvectors
   above the shift and -1 on those below; half of it plus the identity is the projector on the upper invariant subspace. An
   orthonormal basis of either subspace compresses A to a smaller block, down to single components or blocks that are
   a multiple of the identity, where every orthonormal basis is one of eigenvectors.
3. Mean and components (dimensions x 32 at most) are broadcast and every row is projected where it is read.

Entries become ``floor(64 * c) + 1000000``. Defined results: a row whose vector is null, empty or holds a null or an entry that
is not finite gives nothing and does not count; so does a row whose vector has another length than most (ties: the
longer). A component whose eigenvalue is rounding error (constant dimensions, fewer vectors than dimensions) is left out, since it
cannot be scaled to one; with one vector or none the result is empty. Equal rows give equal results, a repeated id gives the
rows of each of its rows, and a null id stays null. ``deviation`` is exact; beyond the range of a long it is null. Entries
beyond 2^46 are set to that bound with their sign, since a double holds no finer steps there. Other columns are not read, whatever
their names. Long vectors cost memory by the square of their length, on the driver and in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: entry x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows of the long result made at a time in a task.
OUT_ROWS = 65_536
#: Largest entry (see above), times SCALE still exact in a double.
LIMIT = float(2**46)
#: Step of a double at 1.
EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------------------------------------- spectral split

def polar_factor(a: np.ndarray) -> np.ndarray | None:
    """Orthogonal polar factor of a symmetric matrix by QDWH; None if the matrix is singular to working precision."""
    n = len(a)
    alpha = np.linalg.norm(a)
    if not alpha:
        return None
    x = a / alpha
    # lower bound of the smallest singular value from the R factor
    r = np.abs(np.linalg.inv(np.linalg.qr(x)[1] + np.eye(n) * EPS * 1e-3)).sum(axis=1).max()
    low = min(1.0, max(1.0 / (r * np.sqrt(n)), EPS / n))
    for _ in range(30):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        w = np.sqrt(1 + d)
        wa = w + np.sqrt(max(8 - 4 * d + 8 * (2 - l2) / (l2 * w), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))[0]
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if 1 - low < 10 * EPS and moved < (10 * EPS) ** (1 / 3):
            break
    return x if np.linalg.norm(x @ x - np.eye(n)) < 1e-8 * np.sqrt(n) else None


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of its complement: leading columns chosen greedily by what
    is left of them (pivoted Gram-Schmidt), then polished by one subspace step."""
    n = len(projector)
    rest, chosen = projector.copy(), []
    for _ in range(rank):
        j = int((rest * rest).sum(0).argmax())
        v = rest[:, j] / np.linalg.norm(rest[:, j])
        chosen.append(v)
        rest -= np.outer(v, v @ rest)
    start = projector @ np.array(chosen).T
    full = np.linalg.qr(np.hstack([start, np.eye(n)]))[0]
    return full[:, :rank], full[:, rank:]


def eigen_split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix by spectral divide-and-conquer."""
    a = (a + a.T) / 2
    floor = EPS * max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    values, vectors = [], []
    todo = [(a, np.eye(len(a)))] if len(a) else []
    while todo:
        block, basis = todo.pop()
        n = len(block)
        middle = np.trace(block) / n
        if n == 1 or np.linalg.norm(block - middle * np.eye(n)) <= floor:
            values += np.diag(block).tolist()
            vectors += list(basis.T)
            continue
        for part in _split(block, floor):
            smaller = part.T @ block @ part
            todo.append(((smaller + smaller.T) / 2, basis @ part))
    order = np.argsort(-np.array(values), kind="stable")
    found = np.array(vectors).T[:, order] if vectors else np.zeros((0, 0))
    # one QR pass keeps the joined bases orthonormal to the last digit; Rayleigh quotients are the eigenvalues
    q, r = np.linalg.qr(found) if len(found) else (found, found)
    q = q * np.sign(np.where(np.diag(r) == 0, 1, np.diag(r))) if len(found) else q
    return np.einsum("ij,ij->j", q, a @ q), q


def _split(block: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Bases of two non-empty invariant subspaces; the shift starts at the median of the diagonal and moves until it
    misses every eigenvalue and separates some."""
    n = len(block)
    radius = np.abs(block).sum(axis=1) - np.abs(np.diag(block))
    lo, hi = (np.diag(block) - radius).min(), (np.diag(block) + radius).max()
    shift = np.median(np.diag(block))
    best = None
    for _ in range(200):
        u = polar_factor(block - shift * np.eye(n))
        if u is None:  # the shift hits an eigenvalue: step aside
            shift += max(floor * 16, (hi - lo) * 1e-7)
            continue
        rank = int(round((np.trace(u) + n) / 2))
        if 0 < rank < n:
            best = _bases((u + np.eye(n)) / 2, rank)
            off = np.linalg.norm(best[0].T @ block @ best[1])
            if off <= 64 * n * max(floor, EPS * np.linalg.norm(block)):
                break
            shift += (hi - lo) * 1e-3 / n  # too near an eigenvalue for a clean split
            continue
        lo, hi = (shift, hi) if rank == n else (lo, shift)
        shift = (lo + hi) / 2
    if best is None:
        raise ArithmeticError("no shift separates the spectrum")
    return best


# -------------------------------------------------------------------------------------------------- statistics

@dataclass(frozen=True)
class Whitening:
    """Fitted state: count, exact sums, components as columns, their eigenvalues, trace of the covariance, largest
    absolute entry of the whitened covariance minus the identity."""
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def _vectors(batch: pa.RecordBatch, dim: int, column: str = "vec") -> np.ndarray:
    """Integer entries (as doubles) of a batch of whole vectors."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(flat, -LIMIT, LIMIT).reshape(-1, dim) * SCALE) + OFFSET


def usable(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, int]:
    """Rows (vec_id, vec) with whole vectors of the commonest length, that length and their number."""
    vec = F.col(vec_col).cast("array<double>")
    sound = df.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    lengths = sound.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    dim, n = (common["dim"], common["n"]) if common else (0, 0)
    return sound.filter(F.size("vec") == dim), dim, n


def _sums(rows: DataFrame, dim: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, np.int64)
        for b in batches:
            total += _vectors(b, dim).astype(np.int64).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)], names=["k", "s"])
    found = rows.select("vec").mapInArrow(run, "k int, s long").groupBy("k").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(dim, np.int64)
    for r in found:
        out[r["k"]] = r["s"]
    return out


def _products(rows: DataFrame, dim: int, prepare) -> np.ndarray:
    """Sum over all rows of the outer product of ``prepare(x)`` with itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                y = prepare(_vectors(b, dim))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            width = len(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total))], names=["k", "row"])
    parts = rows.select("vec").mapInArrow(run, "k int, row array<double>")
    rows_of = parts.select("k", F.posexplode("row").alias("j", "v")).groupBy("k", "j").agg(F.sum("v").alias("v")).toPandas()
    width = int(rows_of["k"].max()) + 1 if len(rows_of) else 0
    out = np.zeros((width, width))
    out[rows_of["k"], rows_of["j"]] = rows_of["v"]
    return out


def fit(rows: DataFrame, dim: int, n: int, components: int = COMPONENTS) -> Whitening:
    """Components of all ``rows`` (vec_id, vec)."""
    sums = _sums(rows, dim)
    near = np.array([round(int(s) / n) if abs(int(s)) < 2**53 else int(s) // n for s in sums], np.float64)
    rest = np.array([int(s) - n * int(m) for s, m in zip(sums, near)], np.float64) / n
    cov = _products(rows, dim, lambda x: x - near) / n - np.outer(rest, rest)
    values, vectors = eigen_split(cov)
    kept = int((values > dim * EPS * 64 * max(values.max(initial=0.0), 0.0)).sum()) if n > 1 else 0
    k = min(components, kept)
    model = Whitening(n, sums, vectors[:, :k], values[:k], float(np.trace(cov)), 0.0)
    if not k:
        return model
    project = _projection(model)
    moment = _products(rows, dim, project) / n  # whitened rows have mean zero
    return Whitening(n, sums, model.components, model.eigenvalues, model.trace, float(np.abs(moment - np.eye(k)).max()))


def _projection(model: Whitening):
    near = np.array([int(s) // model.n for s in model.sums], np.float64)
    rest = np.array([int(s) - model.n * int(m) for s, m in zip(model.sums, near)], np.float64) / model.n
    scale = model.components / np.sqrt(model.eigenvalues)
    return lambda x: ((x - near) - rest) @ scale


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n * x - S)^2, exact; null beyond a long."""
    reach = n * (np.abs(x).max(initial=0.0) + 1) + np.abs(sums.astype(np.float64)).max(initial=0.0)
    if reach < 2.0**62:
        off = n * x.astype(np.int64) - sums
        if float(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return pa.array((off * off).sum(axis=1))
    total = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return pa.array([t if t < 2**63 else None for t in total], pa.int64())


RESULT = ("vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, components numbered from 1 by falling eigenvalue."""
    rows, dim, n = usable(df, id_col, vec_col)
    id_type = rows.schema["vec_id"].dataType
    schema = RESULT.format(id=id_type.simpleString())
    model = fit(rows, dim, n, components) if n > 1 else None
    k = len(model.eigenvalues) if model else 0
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    shared = df.sparkSession.sparkContext.broadcast(model)  # dimensions x components numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        project = _projection(m)
        explained = m.eigenvalues / m.trace
        step = max(1, OUT_ROWS // k)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows_ = part.num_rows
                x = _vectors(part, dim)
                which = pa.array(np.repeat(np.arange(rows_), k))
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(which),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * k, m.n, np.int64)),
                    pc.take(_deviation(x, m.n, m.sums), which),
                    pa.array(project(x).ravel()),
                    pa.array(np.tile(explained, rows_)),
                    pa.array(np.full(rows_ * k, m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)
