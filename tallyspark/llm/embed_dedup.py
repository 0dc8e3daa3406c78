"""Operator 1: near-duplicate vectors by randomised-rotation binary codes.

Every distinct vector is rotated by random orthogonal matrices.  Bands of the
rotated signs are bucket keys: two vectors at the threshold share one of the
bands but for a chance of ``miss``.  Inside a bucket, one vector's one-bit code
and the other's 8-bit planes give, by bit counts alone, the unbiased estimate
``<o_bar, q> / <o_bar, o>`` of their inner product; the stored factor
``<o_bar, o>`` corrects the code's shrinkage.  The error of the estimate for a
pair at the threshold ``t`` is at most ``sqrt(1 - f^2) / f * sqrt(1 - t^2)``
times ``min(1, eps / sqrt(d - 1))`` (a confidence bound; 1 is certain), plus the
rounding error of the planes.  Only pairs whose bound reaches the threshold are
recomputed, in double precision.

Equal vectors are folded into their smallest id first, so a group of copies
costs one row however large it is.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, sized, stage
from .graph import components

SEED = 20240917
PLANES = 8


def band_count(bits: int, threshold: float, miss: float) -> int:
    """Bands of ``bits`` signs so that a pair at the threshold shares none with chance ``miss`` at most."""
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - agree))


def rotations(dim: int, count: int) -> np.ndarray:
    """``count`` random orthogonal matrices, the same in every task."""
    rng = np.random.default_rng(SEED + dim)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(count)])


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 (a multiple of 64 wide) as signed 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def encode(x: np.ndarray, rot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Code words, factor, plane words, low end, step and rounding error of unit rows ``x`` under ``rot``."""
    y = x @ rot
    d = y.shape[1]
    code = y > 0
    factor = np.abs(y).sum(1) / math.sqrt(d)
    low = y.min(1)
    step = (y.max(1) - low) / (2 ** PLANES - 1)
    step[step == 0] = 1.0
    u = np.rint((y - low[:, None]) / step[:, None])
    error = np.linalg.norm(y - (low[:, None] + u * step[:, None]), axis=1)
    u = u.astype(np.uint8)
    planes = np.concatenate([_words((u >> j) & 1) for j in range(PLANES)], axis=1)
    return _words(code), factor, planes, low, step, error


def _distinct(df: DataFrame, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """(id, label, dim, digest, vec): vec is null where the vector links with nothing."""
    kinds = df.schema[id_col].dataType.simpleString(), df.schema[label_col].dataType.simpleString()

    def make():
        def step(batch):
            dims, digests, vecs = [], [], []
            for label, v in zip(batch.column(1).to_pylist(), batch.column(2)):
                x = None
                if label is not None and v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    # a sum that overflows is scaled away; zero and non-finite vectors link with nothing
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                dims.append(None if x is None else len(x))
                digests.append(None if x is None else hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest())
                vecs.append(None if x is None else x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()),
                pa.array(vecs, pa.list_(pa.float64()))], ["vec_id", "label", "dim", "digest", "vec"])
        return step

    return map_rows(df.select(id_col, label_col, vec_col),
                    f"vec_id {kinds[0]}, label {kinds[1]}, dim int, digest binary, vec array<double>", make, 1024)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(reps: DataFrame, width: int, bits: int, bands: int) -> DataFrame:
    """One row per representative and band: bucket key, code, factor, planes."""
    per_rotation = width // bits
    n_rot = -(-bands // per_rotation)
    w = width // 64
    longs = [f"c{i}" for i in range(w)] + [f"p{j}_{i}" for j in range(PLANES) for i in range(w)]
    schema = ("vec_id bigint, label string, dim int, band int, key bigint, " + ", ".join(f"{c} bigint" for c in longs)
              + ", factor double, low double, step double, error double")
    names = [c.split()[0] for c in schema.split(", ")]

    def make():
        rot = rotations(width, n_rot)
        powers = (1 << np.arange(bits, dtype=np.int64))

        def step(batch):
            n = batch.num_rows
            if not n:
                return
            x = np.zeros((n, width))
            for i, v in enumerate(batch.column(3)):
                x[i, :len(v.values)] = v.values.to_numpy(zero_copy_only=False)
            x = _unit(x)
            code, factor, planes, low, step_, error = encode(x, rot[0])
            signs = np.concatenate([(x @ r > 0)[:, :per_rotation * bits] for r in rot], axis=1)[:, :bands * bits]
            keys = signs.reshape(n, bands, bits) @ powers
            at = np.repeat(np.arange(n), bands)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take),
                pa.array(np.tile(np.arange(bands, dtype=np.int32), n)), pa.array(keys.ravel()),
                *(pa.array(np.ascontiguousarray(c[at])) for c in code.T), *(pa.array(np.ascontiguousarray(c[at])) for c in planes.T),
                *(pa.array(v[at]) for v in (factor, low, step_, error))], names)
        return step

    return map_rows(reps.select("vec_id", F.col("label").cast("string"), "dim", "vec"), schema, make, 512)


def _exact(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine in double precision reaches the threshold."""
    width = reps.agg(F.max("dim")).first()[0] or 1
    vecs = sized(reps.select("vec_id", "vec"), 8 * width + 64)
    both = (pairs.join(vecs.withColumnsRenamed({"vec_id": "a", "vec": "va"}), "a")
                 .join(vecs.withColumnsRenamed({"vec_id": "b", "vec": "vb"}), "b"))

    def make():
        def rows(column):
            return np.stack([v.values.to_numpy(zero_copy_only=False) for v in column])

        def step(batch):
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(batch.column(2)):
                by_dim.setdefault(len(v.values), []).append(i)
            for at in by_dim.values():
                part = batch.take(pa.array(at))
                x, y = rows(part.column(2)), rows(part.column(3))
                x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
                cos = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
                keep = pa.array(cos >= threshold)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep),
                                                  pa.array(cos).filter(keep)], ["a", "b", "cosine"])
        return step

    return map_rows(both.select("a", "b", "va", "vb"), "a bigint, b bigint, cosine double", make, 4096)


def links(reps: DataFrame, threshold: float = 0.98, miss: float = 1e-9, eps: float = 6.0) -> DataFrame:
    """(a, b, cosine), a < b: pairs of representatives of equal label and width at the threshold or above.

    ``bits`` of a band grow with the logarithm of the rows, which keeps the
    expected bucket small at any size.
    """
    n, widest = reps.agg(F.count(F.lit(1)), F.max("dim")).first()
    if not n:
        return reps.select(F.col("vec_id").alias("a"), F.col("vec_id").alias("b"), F.lit(1.0).alias("cosine"))
    width = 64 * -(-widest // 64)
    bits = min(max(16, math.ceil(math.log2(n))), 48, width)
    bands = band_count(bits, threshold, miss)
    coded = stage(_coded(reps, width, bits, bands), "embed-codes")
    w = width // 64
    a, b = coded.alias("a"), coded.alias("b")

    def ones(q_word: str, i: int):
        return F.bit_count(F.col(f"a.c{i}").bitwiseAND(F.col(f"b.{q_word}")))

    total = lambda terms: sum(terms[1:], terms[0])
    # <o_bar, q> = (2 * sum of q over the code's ones - sum of q) / sqrt(d), with q = low + step * u
    u_ones = total([ones(f"p{j}_{i}", i) * F.lit(float(1 << j)) for j in range(PLANES) for i in range(w)])
    u_all = total([F.bit_count(F.col(f"b.p{j}_{i}")) * F.lit(float(1 << j)) for j in range(PLANES) for i in range(w)])
    n_ones = total([F.bit_count(F.col(f"a.c{i}")) for i in range(w)])
    dot = (F.col("b.low") * (2 * n_ones - width) + F.col("b.step") * (2 * u_ones - u_all)) / math.sqrt(width)
    f = F.col("a.factor")
    spread = math.sqrt(1 - threshold ** 2) * min(1.0, eps / math.sqrt(max(1, width - 1)))
    near = dot / f >= threshold - F.sqrt(F.greatest(F.lit(0.0), 1 - f * f)) / f * spread - F.col("b.error") / f - 1e-9
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("label", "dim", "band", "key")]
    pairs = (a.join(b, [*same, F.col("a.vec_id") < F.col("b.vec_id"), near])
              .select(F.col("a.vec_id").alias("a"), F.col("b.vec_id").alias("b")).distinct())
    return _exact(stage(pairs, "embed-pairs"), reps, threshold)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                    threshold: float = 0.98, miss: float = 1e-9, eps: float = 6.0) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Rows link when their labels are equal and not null and their cosine reaches
    ``threshold``.  A vector that is null, empty, zero or holds null or
    non-finite parts, or whose label or id is null, links with nothing
    (component_id is its own id; a null id stays null and is kept).  Vectors of
    different lengths never link.  Repeated rows link as copies do.  Other
    columns are left out.
    """
    rows = stage(_distinct(df, id_col, label_col, vec_col)
                 .withColumn("digest", F.when(F.col("vec_id").isNotNull(), F.col("digest"))), "embed-rows")
    group = ["label", "dim", "digest"]
    copies = (rows.filter("digest is not null").groupBy(*group)
                  .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    copies = stage(copies, "embed-copies")
    # one row stands for a group of copies: several rows may carry its smallest id
    reps = stage(rows.filter("digest is not null").join(sized(copies, 96), group)
                     .filter("vec_id = rep").groupBy(*group, "vec_id", "copies").agg(F.first("vec").alias("vec")), "embed-reps")
    found = stage(links(reps, threshold, miss, eps).select("a", "b"), "embed-links")
    weight = copies.select(F.col("rep").alias("other"), "copies")
    ends = found.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(
        found.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    n = ends.join(weight, "other").groupBy("rep").agg(F.sum("copies").alias("near"))
    comp = components(found, "a", "b").withColumnRenamed("node", "rep")
    by_group = (copies.join(n, "rep", "left").join(comp, "rep", "left")
                      .select(*group, (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
                              F.coalesce("component", "rep").alias("component_id")))
    by_group = sized(stage(by_group, "embed-groups"), 112)
    out = rows.select("vec_id", *group).join(by_group, group, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


#: DuckDB SQL for the registered query: all pairs of a label, then everything reachable.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT *, sqrt(list_inner_product(x, x)) AS size FROM v WHERE list_inner_product(x, x) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.x, b.x) / (a.size * b.size) >= 0.98),
reach(node, other) AS (
  SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
least_of AS (SELECT node, min(other) AS low FROM reach GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(low, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least_of l ON l.node = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id"""
