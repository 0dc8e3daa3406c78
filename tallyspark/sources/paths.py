"""Filesystem helpers that go through Hadoop's FileSystem (any scheme)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_local(spark: SparkSession, path: str) -> bool:
    fs, _ = _fs(spark, path)
    return fs.getUri().getScheme() == "file"


def move(spark: SparkSession, src: str, dst_dir: str) -> str:
    fs, s = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    d = jvm.org.apache.hadoop.fs.Path(dst_dir)
    fs.mkdirs(d)
    target = jvm.org.apache.hadoop.fs.Path(d, s.getName())
    if not fs.rename(s, target):
        raise IOError(f"could not move {src} to {dst_dir}")
    return target.toString()


def modified_millis(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Give ``src`` the name ``dst``, which must be free."""
    fs, s = _fs(spark, src)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    if fs.exists(d) or not fs.rename(s, d):
        raise IOError(f"could not rename {src} to {dst}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it does not exist; for folders of bounded length."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
