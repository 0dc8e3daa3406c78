"""Operator 12: exact top-k inner products by MaxScore over shards of an inverted index.

A dimension is a term; a row is in the term's positive or negative posting by the sign
of its entry.  For a query the greatest product that a shard's rows reach in a
term bounds the term's part of any score.  Terms whose bounds together stay
below the k-th best score known are non-essential: a row that gains nothing in the
others cannot compete.  The essential terms are traversed, and the others are probed
from the greatest bound down, for those rows alone that can still reach the k-th
best score.  Shards are merged by score, then id.

Equal vectors are indexed once with their smallest ids (no more can be asked for),
and each distinct query vector is searched once.  Shards gather rows near the
same pivot, so that their bounds are tight; rows and queries meet in a grid of
bounded cells, each cell one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_rows, sized, stage
from .vectors import packed_vectors, padded

#: Quantisation of the contract: ``floor(SCALE * entry)``.
SCALE = 256
#: Rows of a shard and query vectors of a grid cell, at most (about: rows are dealt by hash).
SHARD_ROWS, CELL_QUERIES = 8192, 8192
#: Pivots that shards gather around: the distinct vectors with the smallest hashes.
PIVOTS = 256
#: Non-essential terms probed between two prunings.
PROBE = 8

RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


class Shard:
    """The postings of some vectors: by term the entries of all rows, with the least and greatest one."""

    def __init__(self, x: np.ndarray, top: int):
        """``top``: greatest size of a query entry, which decides whether doubles hold every score exactly."""
        exact = top * int(np.abs(x).max(initial=0)) * x.shape[1] < 1 << 53
        self.terms = np.ascontiguousarray(x.T, dtype=np.float64 if exact else np.int64)
        self.low, self.high = self.terms.min(axis=1), self.terms.max(axis=1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """By query and term: what the term adds to a score at most."""
        return np.where(queries > 0, queries * self.high, queries * self.low)

    def best(self, q: np.ndarray, bound: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all rows whose score is at least both ``floor`` and the k-th best of the shard."""
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)     # rest[i]: bound of the terms order[i:] together
        low = np.flatnonzero(rest[:-1] < floor)
        essential = max(int(low[0]), 1) if len(low) else len(order)
        some = order[:essential]
        score = q[some] @ self.terms[some]
        rows, at = np.arange(len(score)), essential
        if at < len(order):
            # the leaders so far, scored in full, raise the floor
            lead = np.argpartition(-score, k - 1)[:k] if len(score) > k else rows
            if len(lead) == k:
                left = order[at:]
                floor = max(floor, (score[lead] + q[left] @ self.terms[np.ix_(left, lead)]).min())
        while True:
            alive = score + rest[at] >= floor
            if not alive.all():
                rows, score = rows[alive], score[alive]
            if at == len(order) or not len(rows):
                break
            some = order[at:at + PROBE]
            score = score + q[some] @ self.terms[np.ix_(some, rows)]
            at += len(some)
        if len(score) > k:
            keep = score >= np.partition(score, -k)[-k]
            rows, score = rows[keep], score[keep]
        return rows, score


def _flat_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of a list column."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy()


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_cell(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best ``k`` (query number, score, vec_id) of one shard for each query that it can improve."""
    queries, rows = queries.combine_chunks(), rows.combine_chunks()
    out: dict[str, list[np.ndarray]] = {"q": [], "score": [], "vec_id": []}
    if len(queries) and len(rows):
        number, floors = queries.column("q").to_numpy(), queries.column("floor").to_numpy()
        q, x = padded(queries.column("x").chunk(0)), padded(rows.column("x").chunk(0))
        width = max(q.shape[1], x.shape[1], 1)
        q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
        offsets, ids = _flat_ids(rows.column("ids").chunk(0))
        shard = Shard(x, int(np.abs(q).max(initial=0)))
        q = q.astype(shard.terms.dtype)
        for lo in range(0, len(q), 512):
            bound = shard.bounds(q[lo:lo + 512])
            for i in np.flatnonzero(bound.sum(axis=1) >= floors[lo:lo + 512]):
                got, score = shard.best(q[lo + i], bound[i], k, floors[lo + i])
                some = np.concatenate([ids[offsets[r]:offsets[r + 1]] for r in got]) if len(got) else ids[:0]
                score = np.repeat(score, offsets[got + 1] - offsets[got])
                top = _top(score, some, k)
                out["q"].append(np.full(len(top), number[lo + i]))
                out["score"].append(score[top].astype(np.int64))
                out["vec_id"].append(some[top])
    return pa.table({c: pa.array(np.concatenate(v) if v else np.empty(0, np.int64), pa.int64()) for c, v in out.items()})


def _near_pivot(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with ``pivot``: the one of greatest cosine."""
    norms = np.linalg.norm(pivots, axis=1)
    unit = pivots / np.where(norms > 0, norms, 1)[:, None]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields), "pivot int"])

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            x = padded(batch.column("x"), unit.shape[1])
            some = min(x.shape[1], unit.shape[1])
            near = np.argmax(x[:, :some].astype(float) @ unit[:, :some].T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32())], [*batch.schema.names, "pivot"])
        return step

    return map_rows(vectors, schema, make, slice_rows=4096)


def _with_floors(queries: DataFrame, pivots: np.ndarray, copies: np.ndarray, k: int) -> DataFrame:
    """``queries`` with ``floor``: the k-th best score among the pivots and their copies, which the result cannot miss."""
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields), "floor double"])
    places = np.repeat(np.arange(len(pivots)), copies)
    exact = int(np.abs(pivots).max(initial=0))

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            x = padded(batch.column("x"), pivots.shape[1])
            floor = np.full(len(x), -np.inf)
            if len(places) >= k and exact * int(np.abs(x).max(initial=0)) * x.shape[1] < 1 << 53:
                some = min(x.shape[1], pivots.shape[1])
                scores = (x[:, :some].astype(float) @ pivots[:, :some].T.astype(float))[:, places]
                floor = np.partition(scores, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], [*batch.schema.names, "floor"])
        return step

    return map_rows(queries, schema, make, slice_rows=1024)


def _k_least_ids(rows: DataFrame, k: int) -> DataFrame:
    """(x, ids): each distinct vector with its ``k`` smallest ids; a window limit cuts hot vectors before the shuffle."""
    w = Window.partitionBy("x").orderBy("vec_id")
    return (rows.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= k)
                .groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))


def top_k(embeddings: DataFrame, query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows of greatest inner product for each row that ``query`` selects: query_id, rank, vec_id, score.

    ``query`` is a condition on ``vec_id``.  A row is no candidate for its own id; ties go to the
    smaller id; with fewer candidates than ``k`` all are returned.  Rows without
    an id, and vectors that are null or hold a null, a non-finite entry or one of
    65,536 or more in size, take no part.  Equal rows count once; an id with
    several vectors is as many candidates and as many queries.  A vector shorter than
    another counts as padded with zeros.  An empty table, or one without
    queries, gives no rows.  Other columns are ignored.
    """
    spark = embeddings.sparkSession
    packed = packed_vectors(embeddings.filter(F.col(vec_id).isNotNull()), SCALE, F.col(vector), F.col(vec_id).cast("bigint").alias("vec_id"))
    packed = stage(packed.distinct(), "vectors")
    asked = packed.filter(query)
    most = asked.groupBy("vec_id").count().agg(F.max("count")).first()[0]     # vectors of one query id: 1 where ids are unique
    if most is None:
        return spark.createDataFrame([], RESULT)
    ids = k + 1                                                              # of the smallest ids of a vector, one may be the query's own
    want = k + most                                                          # of the best entries, those of the own id are left out later
    vectors = stage(_k_least_ids(packed, ids), "distinct-vectors")
    rows = vectors.count()
    pivots = vectors.orderBy(F.xxhash64("x"), "x").limit(PIVOTS).collect()
    pivot_x, copies = padded(pa.array([bytes(p.x) for p in pivots], pa.binary())), np.array([len(p.ids) for p in pivots])

    # shards: the rows near a pivot, in as many parts as their number asks for
    placed = stage(_near_pivot(vectors, pivot_x), "placed")
    per_shard = max(1, min(SHARD_ROWS, -(-rows // max(2 * spark.sparkContext.defaultParallelism, 1))))
    sizes = {r.pivot: r["count"] for r in placed.groupBy("pivot").count().collect()}     # PIVOTS rows at most
    first, parts, n_shards = _shards(sizes, per_shard)
    shard_of = F.create_map([F.lit(v) for p in sizes for v in (p, first[p])])
    parts_of = F.create_map([F.lit(v) for p in sizes for v in (p, parts[p])])
    shard = shard_of[F.col("pivot")] + F.pmod(F.xxhash64("x"), parts_of[F.col("pivot")])

    distinct = asked.select("x").distinct()
    numbered = stage(_with_floors(distinct.withColumn("q", F.monotonically_increasing_id()), pivot_x, copies, want), "queries")
    cells = -(-numbered.count() // CELL_QUERIES)
    queries = (numbered.withColumn("cell", F.pmod(F.xxhash64("q"), F.lit(cells)))
                       .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_shards - 1).cast("bigint")))))
    index = placed.select("x", "ids", shard.cast("bigint").alias("shard")).withColumn(
        "cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint"))))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return search_cell(a, b, want)

    found = (queries.groupBy("cell", "shard").cogroup(index.groupBy("cell", "shard"))
                    .applyInArrow(cell, "q bigint, score bigint, vec_id bigint"))
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    best = (found.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= want)
                 .groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("best")))
    best = stage(numbered.select("q", "x").join(best, "q").select("x", "best"), "best")

    # back to the rows that asked; a vector that many rows hold is dealt over eight parts
    salts = 8
    spread = sized(best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), 256 + 32 * want)
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))
    own = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return (asked.withColumnRenamed("vec_id", "query_id").join(spread, ["x", "salt"])
                 .select("query_id", F.posexplode(own).alias("nth", "b"))
                 .select("query_id", (F.col("nth") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                         (-F.col("b.down")).alias("score")))


def _shards(sizes: dict[int, int], per_shard: int) -> tuple[dict[int, int], dict[int, int], int]:
    """(first shard, parts, shards in all) by pivot; neighbouring small groups share a shard."""
    first, parts, n, room = {}, {}, 0, 0
    for p, size in sorted(sizes.items()):
        parts[p] = max(1, -(-size // per_shard))
        if parts[p] > 1:
            first[p], n, room = n, n + parts[p], 0
        elif size <= room:
            first[p], room = n - 1, room - size
        else:
            first[p], n, room = n, n + 1, per_shard - size
    return first, parts, n


#: DuckDB SQL for the registered query: every query against every row.
SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
