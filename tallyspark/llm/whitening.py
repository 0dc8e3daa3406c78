"""Operator 11: whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Rows are quantised to integers and each distinct vector is fitted once.  X is the
matrix of the distinct vectors less their mean.  A step gives the next right
vector v, the left one u = (Xv less its parts along earlier u) / alpha, and Xᵀu,
whose part that is orthogonal to all v is the next v times beta.  X is upper
bidiagonal between the two bases, so the singular values and right vectors of a
small bidiagonal matrix give the components and deviations.

Left vectors are as long as the table; none is stored.  Each is X times a short
vector w kept by the driver, so Xᵀu comes from the same pass over the rows as
u itself, and the full reorthogonalisation of the left side needs only products of
short vectors: u_i . p = w_i . (Xᵀp).  A pass returns d + 2 sums a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, stage
from .vectors import integers, packed_vectors, unpack

#: Quantisation of the contract: ``floor(SCALE * entry) + OFFSET``.
SCALE, OFFSET = 64, 1_000_000
#: Vectors with an entry of this size or more after scaling are left out; sums and centred entries stay exact below it.
LIMIT = 1 << 50
#: Partial sums of a pass are added on the driver up to this many bytes, by a shuffle beyond.
PARTIAL_BYTES = 16 << 20
#: A deviation below this share of the greatest is rounding, not a component.
RANK_TOLERANCE = 1e-10

ROWS = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


@dataclass
class Fit:
    """``n`` distinct vectors of ``dim`` entries with sums ``sums`` (without OFFSET); components are rows."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    steps: int


def _center(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and fractions: entries less both are rounded once."""
    whole = [round(s / n) for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole)])


def _sums(rows: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], few: bool) -> np.ndarray:
    """Sum of ``part(matrix)`` (``width`` doubles) over all packed vectors: one row a task, then added up."""
    def make():
        total = np.zeros(width)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for _, x in unpack(batch.column("x")):
                total[:] += part(x)
            return iter(())

        def close() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])
        step.close = close
        return step

    parts = map_rows(rows.select("x"), "sums array<double>", make, slice_rows=4096)
    if few:
        got = [r.sums for r in parts.collect()]
        return np.sum(np.array(got), axis=0) if got else np.zeros(width)
    out = np.zeros(width)
    for r in parts.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect():
        out[r.pos] = r.s
    return out


def _exact_sums(rows: DataFrame, dim: int) -> tuple[int, int, list[int]]:
    """(vectors, tasks, exact sums by dimension)."""
    def make():
        total = [0] * (dim + 1)                              # a slice of 4096 entries below 2**50 stays within 64 bits

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for _, x in unpack(batch.column("x")):
                total[:] = [a + b for a, b in zip(total, [len(x), *x.sum(axis=0).tolist()])]
            return iter(())

        def close() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()),
                                              pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["at", "s"])
        step.close = close
        return step

    parts = map_rows(rows.select("x"), "at int, s decimal(38,0)", make, slice_rows=4096)
    got = {r["at"]: (int(r.s), r.tasks) for r in
           parts.groupBy("at").agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("tasks")).collect()}
    n, tasks = got.get(-1, (0, 0))
    return n, tasks, [got.get(i, (0, 0))[0] for i in range(dim)]


def distinct_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``x binary``: each distinct integer vector once; copies fold before and after the shuffle."""
    return packed_vectors(embeddings, SCALE, F.col(vector), limit=LIMIT).select("x").distinct()


def commonest_length(rows: DataFrame) -> int:
    """The vector length that most distinct vectors have (the greater one of two); 0 without rows.

    The first byte of a packed vector is its entry width, written as two hexadecimal digits here.
    """
    width = F.conv(F.hex(F.substring("x", 1, 1)), 16, 10).cast("int")
    size = ((F.octet_length("x") - 1) / width).cast("int")
    got = rows.groupBy(size.alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return 0 if got is None else got["dim"]


def _of_length(rows: DataFrame, dim: int) -> DataFrame:
    return rows.filter(F.octet_length("x").isin(*[1 + w * dim for w in (1, 2, 4, 8)])
                       & (F.octet_length("x") == 1 + dim * F.conv(F.hex(F.substring("x", 1, 1)), 16, 10).cast("int")))


def bidiagonalise(rows: DataFrame, n: int, sums: list[int], tasks: int, k: int, seed: int = 11) -> Fit:
    """The ``k`` leading components of the packed vectors ``rows``, all of one length.

    Steps end when the leading triplets have converged and what variance the basis
    has not met is below the last of them, so that no copy of a multiple
    eigenvalue is missed; after one step a dimension at the latest.  A
    vector that the recurrence cannot continue from is replaced by a random one.
    """
    dim = len(sums)
    whole, part = _center(n, sums)
    few = tasks * (dim + 2) * 8 <= PARTIAL_BYTES

    def sweep(w: np.ndarray) -> tuple[float, float, np.ndarray]:
        """(|X|**2, |Xw|**2, XᵀXw), the product with Xᵀ taken of Xw row by row."""
        def of(x: np.ndarray) -> np.ndarray:
            c = (x - whole) - part
            u = c @ w
            return np.concatenate([[np.einsum("ij,ij->", c, c), u @ u], c.T @ u])
        got = _sums(rows, dim + 2, of, few)
        return got[0], got[1], got[2:]

    rng = np.random.default_rng(seed)
    V, W, G = np.zeros((dim, 0)), np.zeros((dim, 0)), np.zeros((dim, 0))
    alphas, betas = [], []

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - V @ (V.T @ v)
        return v

    v, square = rng.standard_normal(dim), None
    v /= np.linalg.norm(v)
    while True:
        V = np.column_stack([V, v])
        w, size = v, 0.0
        for _ in range(3):                                   # again while most of the vector was cancelled
            w = w - W @ (G.T @ w)
            total, size, h = sweep(w)
            square = total if square is None else square
            drift = W.T @ h                                  # what is left along the earlier left vectors
            w, h = w - W @ drift, h - G @ drift
            left = size - drift @ drift
            if left > .5 * size or size <= 1e-26 * square:
                break
        tiny = 1e-13 * np.sqrt(square)
        alpha = np.sqrt(left) if left > 0 else 0.0
        if alpha <= tiny:
            alpha, w, g = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            w, g = w / alpha, h / alpha
        W, G = np.column_stack([W, w]), np.column_stack([G, g])
        alphas.append(alpha)
        r = orthogonal(g)
        beta = float(np.linalg.norm(r))
        j = len(alphas)
        B = np.diag(alphas) + np.diag(betas, 1)
        done = j == dim
        if not done and (j % 8 == 0 or beta <= tiny):
            left_vectors, s, _ = np.linalg.svd(B)
            if j >= k and (beta * np.abs(left_vectors[-1, :k]) <= 1e-15 * s[0]).all():
                done = square - (s * s).sum() < s[k - 1] ** 2
        if done:
            break
        if beta <= tiny:
            betas.append(0.0)
            v = orthogonal(rng.standard_normal(dim))
            v /= np.linalg.norm(v)
        else:
            betas.append(beta)
            v = orthogonal(r / beta)
            v /= np.linalg.norm(v)
    _, s, right = np.linalg.svd(B)
    keep = min(k, int((s > RANK_TOLERANCE * max(s[0], 1e-300)).sum()))
    return Fit(n, sums, right[:keep] @ V.T, s[:keep] ** 2 / n, square / n, len(alphas))


def fit(rows: DataFrame, k: int = 16) -> Fit:
    """Fit the distinct packed vectors ``rows`` (a written table: it is read once a step)."""
    dim = commonest_length(rows)
    if not dim:
        return Fit(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    rows = _of_length(rows, dim)
    n, tasks, sums = _exact_sums(rows, dim)
    return bidiagonalise(rows, n, sums, tasks, min(k, dim))


def _projection(model: Fit) -> Callable[[np.ndarray], np.ndarray]:
    whole, part = _center(model.n, model.sums)
    matrix = model.components.T / np.sqrt(model.eigenvalues)
    return lambda x: ((x - whole) - part) @ matrix


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured over the fit list."""
    project, k = _projection(model), len(model.eigenvalues)
    rows = _of_length(rows, len(model.sums))

    def of(x: np.ndarray) -> np.ndarray:
        z = project(x)
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    got = _sums(rows, k + k * k, of, few=False) / model.n
    return float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * entry - sum)**2 by row, exact; null beyond 64 bits."""
    s = np.array(sums, object)
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if top * top * x.shape[1] < 1 << 63:
        d = n * x - s.astype(np.int64)
        return np.einsum("ij,ij->i", d, d).tolist()
    exact = ((n * x.astype(object) - s) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(embeddings: DataFrame, k: int = 16, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold a null, a non-finite entry or one of 2**44 or
    more in size are left out, and so are vectors of another length than most
    distinct vectors have.  Copies and repeated ids are whitened row by row and
    fitted once; a null id stays null.  Directions without deviation (below 1e-10 of
    the greatest one) are no components, so equal vectors, or one alone, give no
    rows, as an empty table does.  A deviation beyond 64 bits is null.
    Other columns of the table are ignored.
    """
    spark = embeddings.sparkSession
    rows = stage(distinct_vectors(embeddings, vector), "fit-list")
    model = fit(rows, k)
    if not len(model.eigenvalues):
        return spark.createDataFrame([], ROWS)
    error = identity_error(rows, model)
    return apply(embeddings, model, error, vec_id, vector)


def apply(embeddings: DataFrame, model: Fit, error: float, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The rows of ``whiten`` for any table, by a fitted model."""
    kept, dim, n, sums = len(model.eigenvalues), len(model.sums), model.n, model.sums
    project, explained = _projection(model), model.eigenvalues / model.trace
    df = embeddings.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("x"))

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for rows, x in integers(batch.column("x"), SCALE, LIMIT):
                if x.shape[1] != dim:
                    continue
                ids = batch.column("vec_id").take(pa.array(np.repeat(rows, kept)))
                m = len(rows)
                dev = pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), kept)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)), pa.array(np.full(m * kept, n)), dev,
                    pa.array(project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * kept, error))],
                    names=[f.split()[0] for f in ROWS.split(", ")])
        return step

    return map_rows(df, ROWS, make, slice_rows=4096)
