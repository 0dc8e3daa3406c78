"""Table sources: parquet inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def balanced(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has cores.

    A large input already has one split per file block and is returned as is
    (no shuffle).  A small file written as one row group scans as a single
    task; a round-robin repartition then lets the CPU-heavy parse use every
    core.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    # estimate the splits from the planner's size statistics (file sizes), no job
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()   # in bytes, whatever unit it was set in
    if size // max(split, 1) + 1 < want:
        return df.repartition(want)
    return df
