"""Raw bytes to and from shared storage, through Spark's own readers and writers where they can."""

from __future__ import annotations

import re

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_bytes(df: DataFrame, column: str, path: str, end: bytes) -> None:
    """Write each row's bytes in turn, one file per partition, through Spark's commit protocol.

    The text writer puts a separator after each row, so rows must come without
    their last byte: that byte is ``end`` for all of them.
    """
    (df.select(F.col(column).cast("string").alias("value"))
       .write.option("lineSep", end.decode("ascii")).text(path))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the data files below ``path``; their content is not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .select("path", "length"))


def open_file(uri: str) -> pafs.NativeFile:
    """A file on any store that pyarrow knows (file, hdfs, s3, gs), open for reads at any offset."""
    if re.match(r"file:/(?!/)", uri):
        uri = "file://" + uri[5:]
    store, path = pafs.FileSystem.from_uri(uri)
    return store.open_input_file(path)
