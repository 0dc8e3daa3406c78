"""Connected components by alternating large-star and small-star steps.

Every step is a partial aggregate plus an equi-join on edge tables; nothing is
collected.  Each round's edges are written to the shared scratch folder, so the
plan stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Nulls and self-loops are ignored, repeated edges are harmless; no edges give no rows.
    """
    edges = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .filter("u != v").distinct(), "cc")
    seen = _fingerprint(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stage(large, "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        e = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
