import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import maxscore as ms, vectors

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, asks, k=5):
    kept = set()
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(np.array(v, np.float32)).all():
            kept.add((i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)))
    out = []
    for i, q in kept:
        if asks(i):
            best = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in kept if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def found(spark, rows, query=None, k=5, parts=4):
    df = spark.createDataFrame([(i, 0, v) for i, v in rows], SCHEMA).selectExpr("*", "1 AS x", "'s' AS score", "2 AS shard")
    query = F.col("vec_id") % 50 == 0 if query is None else query
    return sorted(tuple(r) for r in ms.top_k(df.repartition(parts), query, k).collect())


@pytest.mark.parametrize("rows_per_shard,cells", [(8192, 8192), (40, 3)])
def test_like_all_pairs(spark, monkeypatch, rows_per_shard, cells):
    monkeypatch.setattr(ms, "SHARD_ROWS", rows_per_shard)
    monkeypatch.setattr(ms, "CELL_QUERIES", cells)
    monkeypatch.setattr(ms, "PIVOTS", 9)
    rng = np.random.default_rng(rows_per_shard)
    centres = rng.standard_normal((12, 20))
    rows = [(i, (centres[i % 12] * rng.choice([0, 1, 3]) + rng.standard_normal(20) * rng.choice([.05, 1])).tolist()) for i in range(600)]
    rows += [(i, rows[50][1]) for i in range(600, 900)]                              # a hot vector, ties everywhere
    rows += [(i, [-c for c in rows[7][1]]) for i in range(900, 960)]
    rows += [(2000, None), (2050, [None] + [1.0] * 19), (2100, [float("nan")] * 20), (2150, [float("-inf")] * 20), (None, rows[0][1])]
    rows += [(2200, [0.0] * 20), (2250, rows[0][1][:7]), (2300, []), rows[100], (150, rows[3][1])]  # short, repeated, two vectors of an id
    assert found(spark, rows) == brute(rows, lambda i: i % 50 == 0)


def test_all_scores_negative_few_rows_and_none(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (np.abs(rng.standard_normal(6)) * (-1 if i else 1)).tolist()) for i in range(40)]
    assert found(spark, rows) == brute(rows, lambda i: i % 50 == 0)
    assert found(spark, rows[:3], F.lit(True)) == brute(rows[:3], lambda i: True)
    assert found(spark, rows[:1]) == [] and found(spark, []) == [] and found(spark, rows[1:5]) == []
    assert found(spark, [(50, [1.0]), (50, [1.0]), (50, [2.0])]) == []
    df = ms.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0)
    assert [f"{a} {b}" for a, b in df.dtypes] == ms.RESULT.split(", ")


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-60000, 60000, 12) + .5).tolist()) for i in range(120)]
    assert found(spark, rows) == brute(rows, lambda i: i % 50 == 0)


def test_shard_gives_whole_ties_and_prunes(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (500, 16))
    x[100:130] = x[5]
    shard = ms.Shard(x, 300)
    for q in [x[5].astype(float), *rng.integers(-300, 300, (40, 16)).astype(float)]:
        scores = (x @ q).astype(int)
        for floor in (-np.inf, float(np.sort(scores)[-20]), float(scores.max()), float(scores.max()) + 1):
            rows, got = shard.best(q, shard.bounds(q[None])[0], 6, floor)
            cut = max(np.sort(scores)[-6], floor)
            assert dict(zip(rows.tolist(), got.astype(int).tolist())) == {i: s for i, s in enumerate(scores.tolist()) if s >= cut}


def test_registered_query_sql_and_brute_force(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in E.queries()["op12_exact_top_k"](spark, sf).select("query_id", "rank", "vec_id", "score").collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = sorted(con.sql(E.oracle_sql()["op12_exact_top_k"]).fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got == want == brute(rows, lambda i: i % 50 == 0) and got


def test_cell_without_rows_or_queries():
    q = pa.table({"q": [1], "floor": [-np.inf], "x": pa.array([b"\x01\x05"], pa.binary())})
    none = pa.table({"x": pa.array([], pa.binary()), "ids": pa.array([], pa.list_(pa.int64()))})
    assert ms.search_cell(q, none, 3).num_rows == 0
    assert vectors.padded(q.column("x").chunk(0)).tolist() == [[5]]
