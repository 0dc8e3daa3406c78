import numpy as np
import pytest

from tallyspark.llm import embed_dedup as ed

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, t=.98):
    """vec_id -> (n_links, component) by all pairs; ids must be unique."""
    ok = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, np.float32).astype(float)
            ok[i] = (label, x / np.linalg.norm(x))
    near = {i: [j for j in ok if j != i and ok[i][0] == ok[j][0] and len(ok[i][1]) == len(ok[j][1]) and ok[i][1] @ ok[j][1] >= t] for i in ok}
    comp = {i: i for i, *_ in rows}
    while True:
        new = {i: min([comp[i], *(comp[j] for j in near.get(i, ()))]) for i in comp}
        if new == comp:
            return {i: (len(near.get(i, ())), comp[i]) for i in comp}
        comp = new


@pytest.mark.parametrize("dim", [64, 5, 100])
def test_like_all_pairs(spark, dim):
    rng = np.random.default_rng(dim)
    rows = []
    for g in range(25):
        c = rng.standard_normal(dim)
        for k in range(rng.integers(1, 7)):
            noise = rng.standard_normal(dim) / np.sqrt(dim) * np.linalg.norm(c) * rng.choice([0, .05, .14, .2, .21])
            rows.append((len(rows), int(g % 2), (c + noise).astype(np.float32).tolist()))
    rows += [(1000, 0, None), (1001, 0, [0.0] * dim), (1002, 0, [float("nan")] + [1.0] * (dim - 1)), (1003, None, rows[0][2]),
             (1004, 0, [None] + [1.0] * (dim - 1)), (1005, 0, []), (1006, 0, rows[0][2][:-1]), (1007, 0, rows[0][2])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS dim", "'d' AS digest", "2 AS rep")
    got = {r.vec_id: (r.n_links, r.component_id) for r in ed.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_copies_repeats_null_ids_and_no_rows(spark):
    v = np.random.default_rng(1).standard_normal(64).tolist()
    rows = [(i, 1, v) for i in range(50)] + [(7, 1, v), (None, 1, v)]
    got = ed.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 52
    assert {(r.n_links, r.component_id) for r in got if r.vec_id is not None} == {(50, 0)}
    assert [r.vec_id for r in got if r.kept] == [0, None] or {r.vec_id for r in got if r.kept} == {0, None}
    assert [(r.n_links, r.component_id) for r in got if r.vec_id is None] == [(0, None)]
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = x + rng.standard_normal((300, 64)) * .02
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    true, errors = (x * q).sum(1), []
    for rot in ed.rotations(64, 40):
        y, z = x @ rot, q @ rot
        f = np.abs(y).sum(1) / 8
        estimate = (np.sign(y) * z).sum(1) / 8 / f
        assert (np.abs(estimate - true) <= np.sqrt(1 - f * f) / f * np.sqrt(1 - true ** 2) + 1e-9).all()
        errors.append(estimate - true)
    assert abs(np.mean(errors)) < 2e-3
    assert ed.band_count(16, .98, 1e-9) * np.log(1 - (1 - np.arccos(.98) / np.pi) ** 16) <= np.log(1e-9)
