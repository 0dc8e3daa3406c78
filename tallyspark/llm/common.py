"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path
from ..sources.paths import delete

#: A table is broadcast only when its counted rows stay within this many bytes.
BROADCAST_BYTES = 32 << 20

#: Bytes, about, of the Arrow batches that Spark sends to Python, unless the session names another limit.
BATCH_BYTES = 4 << 20

_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what was made from them is staged itself."""
    for t in tables:
        delete(t.sparkSession, t._scratch)


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its counted rows fit the limit, else unchanged (shuffle join)."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def sized_lists(df: DataFrame, column: str, item_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Like ``sized`` for rows that hold a list: the items are counted."""
    rows, items = df.agg(F.count(F.lit(1)), F.sum(F.size(column))).first()
    return F.broadcast(df) if rows * 64 + (items or 0) * item_bytes <= limit else df


_KEPT: dict[Hashable, object] = {}
_ASKED: set[Hashable] = set()


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """``make()``, once in this process for all tasks that ask for ``key`` one after the other."""
    _ASKED.add(key)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def begin(make: Callable[[], object]) -> object:
    """``make()`` for a new task; what earlier tasks kept and this one did not ask for is let go.

    Spark hands a worker from one operator to the next: a vocabulary and its
    memories would stay beside all that the next one needs.
    """
    _ASKED.clear()
    step = make()
    others = _KEPT.keys() - _ASKED
    for key in others:
        del _KEPT[key]
    if others:
        gc.collect()                                   # they refer to themselves
    _release()
    return step


def _release() -> None:
    """Give freed memory back to the system: Arrow's, and with glibc what lies between live objects, which it keeps otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES instead of Spark's default of 64 MB: both sides hold a batch of each task, outside the heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, str(BATCH_BYTES))


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
             slice_rows: int = 256) -> DataFrame:
    """Arrow map over ``df``: ``make()`` runs once per task, its result once per slice of rows.

    Slices keep the Python side to a few hundred texts at a time, whatever the
    size of the batches that Spark sends; these are bounded in bytes.
    """
    _bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = begin(make)
        for batch in batches:
            for lo in range(0, batch.num_rows, slice_rows):
                yield from step(batch.slice(lo, slice_rows))
        last = getattr(step, "close", None)
        if last is not None:
            yield from last()

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def lower_az(col: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the locale."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class WordHash(dict):
    """bytes -> 64-bit hash, remembered; two generations bound the memory."""

    def __init__(self, size: int = 1 << 16):
        self.size, self.old = size, {}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        h = self.old.get(word)
        if h is None:
            h = xxhash.xxh3_64_intdigest(word)
        self[word] = h
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


#: Masks that keep the first 0 to 8 bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Words up to this many bytes are hashed as columns, eight bytes at a time; longer ones one by one.
_COLUMN_BYTES = 64


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words (runs without ASCII white space) of a text, in order; nothing is remembered."""
    padded = b"".join((b" ", text, b" " * 8))
    raw = np.frombuffer(padded, np.uint8)
    space = (raw == 32) | (raw - np.uint8(9) < 5)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, left = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray(len(raw) - 7, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    eight = lambda at, n: eights[at] & _FIRST_BYTES[np.minimum(n, 8)]
    out = mix64(left.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + eight(starts, left))
    more = np.flatnonzero(left > 8)
    for k in range(8, _COLUMN_BYTES, 8):
        if not len(more):
            break
        out[more] = mix64(out[more] * np.uint64(0xE7037ED1A0B428DB) + eight(starts[more] + k, left[more] - k))
        more = more[left[more] > k + 8]
    for i in more.tolist():
        out[i] = xxhash.xxh3_64_intdigest(padded[starts[i]:starts[i] + left[i]])
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words (a polynomial in an odd base, then mixed)."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    base, out = np.uint64(0xC2B2AE3D27D4EB4F), np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = out * base + words[j:len(words) - n + 1 + j]
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def summed_counts(parts: DataFrame, n_blocks: int, dtype: str = "<i8") -> np.ndarray:
    """Add up per-task count blocks (``block int, counts binary``) in Spark.

    The result has a fixed size (blocks times block length), whatever the input.
    """
    def add(table: pa.Table) -> pa.Table:
        total = None
        for b in table.column("counts").to_pylist():
            x = np.frombuffer(b, dtype=dtype)
            total = x.astype("<i8") if total is None else total + x
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                         "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    rows = parts.select("block", "counts").groupBy("block").applyInArrow(add, "block int, counts binary").collect()
    got = {r.block: np.frombuffer(bytes(r.counts), dtype="<i8") for r in rows}
    if not got:
        return np.zeros(0, dtype=np.int64)
    width = len(next(iter(got.values())))
    return np.concatenate([got.get(b, np.zeros(width, dtype=np.int64)) for b in range(n_blocks)])


def count_blocks(counts: np.ndarray, n_blocks: int, dtype: str = "<i8") -> tuple[pa.Array, pa.Array]:
    return (pa.array(range(n_blocks), pa.int32()),
            pa.array([x.astype(dtype).tobytes() for x in np.split(counts, n_blocks)], pa.binary()))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on every executor, once per application.

    The archive is put in the shared scratch folder, from where Spark hands it out.
    """
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    if f"{name}.zip" in sc._python_includes:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}/{name}.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
