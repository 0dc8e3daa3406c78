from fractions import Fraction

import numpy as np
import pytest

from tallyspark.llm import vectors, whitening as wh

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, k=16):
    """vec_id -> [(component, n, deviation, |whitened|, explained)] by the singular value decomposition of the centred rows."""
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v]) for i, v in rows
            if v is not None and None not in v and np.isfinite(np.array(v, np.float32)).all()]
    x = np.array(sorted({tuple(v) for _, v in kept}), object)
    n, s = len(x), x.sum(axis=0)
    mean = [Fraction(int(a), n) for a in s]
    c = np.array([[float(a - m) for a, m in zip(r, mean)] for r in x])
    _, sv, comp = np.linalg.svd(c, full_matrices=False)
    e, comp, order = sv * sv / n, comp.T, range(min(k, len(sv)))
    out = []
    for i, v in kept:
        d = sum((n * a - int(b)) ** 2 for a, b in zip(v, s))
        z = np.array([float(a - m) for a, m in zip(v, mean)]) @ comp[:, :k] / np.sqrt(e[:k])
        out.append((i, [(q + 1, n, d if d < 1 << 63 else None, abs(z[q]), e[order[q]] / e.sum()) for q in range(len(order))]))
    return out


def collected(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, []).append((r.component, r.n, r.deviation, abs(r.whitened), r.explained))
        assert r.identity_error <= 1e-9
    return {i: sorted(v) for i, v in got.items()}


def same(got, want):
    assert set(got) == {i for i, _ in want}
    for i, w in want:
        for a, b in zip(got[i], w, strict=True):
            assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-7, abs=1e-7) and a[4] == pytest.approx(b[4], rel=1e-9)


@pytest.mark.parametrize("dim,n", [(24, 400), (5, 60), (40, 30)])
def test_like_the_covariance_matrix(spark, dim, n):
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((n, dim)) * rng.uniform(.2, 4, dim) + rng.uniform(-50, 50, dim)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(n)]                      # a hot vector counts once
    broken = [(2000, None), (2001, [None] + rows[0][1][1:]), (2002, [float("nan")] * dim), (2003, [float("inf")] * dim)]
    df = spark.createDataFrame([(i, 0, v) for i, v in rows + broken], SCHEMA)
    df = df.selectExpr("*", "1 AS x", "'c' AS component", "2 AS n").repartition(5)
    same(collected(wh.whiten(df)), brute(rows + broken, min(16, dim)))


def test_graded_scales_keep_their_small_directions(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 8)) * np.array([3e6, 1e5, 1e4, 300, 30, 10, 3, 1])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    same(collected(wh.whiten(spark.createDataFrame([(i, 0, v) for i, v in rows], SCHEMA))), brute(rows, 8))


def test_equal_eigenvalues_are_all_found(spark):
    dim = 6
    rows = [(2 * d + s, [float((1 - 2 * s) * 8 * (i == d)) for i in range(dim)]) for d in range(dim) for s in (0, 1)]
    got = wh.whiten(spark.createDataFrame([(i, 0, v) for i, v in rows], SCHEMA)).collect()
    assert sorted({r.component for r in got}) == [1, 2, 3, 4, 5, 6]
    assert all(abs(r.explained - 1 / dim) < 1e-12 and r.identity_error < 1e-12 for r in got)


def test_constant_directions_repeats_other_lengths_and_empty_tables(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 0, [*rng.standard_normal(3).tolist(), 5.0]) for i in range(40)]
    more = rows + [rows[0], (None, 0, rows[1][2]), (77, 0, [1.0, 2.0]), (78, 0, [])]
    got = wh.whiten(spark.createDataFrame(more, SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2, 3} and len(got) == 42 * 3
    assert sum(r.vec_id is None for r in got) == 3 and not {77, 78} & {r.vec_id for r in got}
    for few in ([], rows[:1], [rows[0]] * 5, [(1, 0, None)], [(1, 0, [])]):
        df = wh.whiten(spark.createDataFrame(few, SCHEMA))
        assert df.count() == 0 and [f"{a} {b}" for a, b in df.dtypes] == wh.ROWS.split(", ")


def test_partial_sums_by_shuffle_and_deviations_beyond_64_bits(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((90, 7)).astype(np.float32) * 3)]
    monkeypatch.setattr(wh, "PARTIAL_BYTES", 0)
    same(collected(wh.whiten(spark.createDataFrame([(i, 0, v) for i, v in rows], SCHEMA).repartition(4))), brute(rows, 7))
    x = np.array([[1 << 30, 0], [0, 1]])
    assert wh.deviations(x, 1 << 10, [0, 0]) == [None, 1 << 20]
    assert wh.deviations(x[1:], 3, [1, 2]) == [1 + 1]


def test_early_end_needs_the_rest_to_be_small(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((500, 60)) * np.r_[100 * .5 ** np.arange(8), np.full(52, .01)]
    df = spark.createDataFrame([(i, 0, (v * 40).tolist()) for i, v in enumerate(x)], SCHEMA)
    model = wh.fit(wh.distinct_vectors(df), 4)
    assert model.steps < 60
    q = np.floor((x * 40).astype(np.float32).astype(float) * 64)
    e = np.linalg.eigvalsh(np.cov(np.unique(q, axis=0).T, bias=True))[::-1]
    assert model.eigenvalues == pytest.approx(e[:4], rel=1e-12)


def test_packed_vectors_are_canonical():
    x = np.array([[0, 1], [127, -128], [128, 0], [1 << 20, 3], [1 << 40, -5]])
    import pyarrow as pa
    data = [None] * 5
    for rows, b in vectors.pack(x):
        for i, v in zip(rows, b.to_pylist()):
            data[i] = v
    assert [d[0] for d in data] == [1, 1, 2, 4, 8]
    assert (vectors.padded(pa.array(data, pa.binary())) == x).all()
    assert (vectors.padded(pa.array(data, pa.binary()).slice(2), 4)[:, :2] == x[2:]).all()
