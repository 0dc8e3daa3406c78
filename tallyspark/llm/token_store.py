"""Operator 5: token ids in files of directly addressable codes.

An id is cut into 8-bit chunks, lowest first.  Level 0 holds the first chunk of
every id, level ``l + 1`` the next chunk of those ids that go on; a bitmap per
level says which go on, and a rank directory (ones before every 512 bits) turns
a position on one level into the position on the next.  Any id is so read with
one byte, one bitmap block and one directory entry per level; nothing else is
decoded.

A file is a sequence of segments, each complete in itself (little endian)::

    magic 8 | length u64 | n_docs u64 | n_tokens u64 | n_levels u64 | ids a level u64[n_levels]
    doc_id i64[n_docs] | null u8[n_docs, padded to 8] | first token u64[n_docs + 1]
    per level: chunks u8[n, padded to 8] | bitmap u64[ceil(n / 64)] | ranks u64[ceil(n / 512) + 1]
    seven zero bytes | 0x0A

A document never spans segments; a segment ends at the first document that
brings it to ``segment_tokens``.
"""

from __future__ import annotations

import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from .chunks import ChunkEncoder, Generations
from .common import map_rows, sized, stage, texts
from .files import list_files, open_file, write_bytes

MAGIC = b"DACIDS1\x00"
END = b"\n"
_HEAD = struct.Struct("<8s4Q")


def _pad(b: bytes) -> bytes:
    return b + b"\x00" * (-len(b) % 8)


# ------------------------------------------------------------------- format
def segment(doc_ids: list[int | None], ids: np.ndarray, starts: np.ndarray) -> bytes:
    """The bytes of one segment: documents ``doc_ids`` whose ids begin at ``starts`` (one more at the end)."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        on = rest > 255
        bits = np.packbits(on, bitorder="little").tobytes()
        bits += b"\x00" * (-len(bits) % 8)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(np.frombuffer(bits, "<u8")))]).astype("<u8")
        ranks = np.append(ones[:-1][::8], ones[-1]) if len(on) else np.zeros(1, "<u8")
        levels.append((len(rest), _pad((rest & 255).astype(np.uint8).tobytes()) + bits + ranks.astype("<u8").tobytes()))
        if not on.any():
            break
        rest = rest[on] >> 8
    body = b"".join([
        struct.pack(f"<{len(levels)}Q", *(n for n, _ in levels)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        _pad(bytes(d is None for d in doc_ids)),
        starts.astype("<u8").tobytes(),
        *(b for _, b in levels), b"\x00" * 7 + END])
    return _HEAD.pack(MAGIC, _HEAD.size + len(body), len(doc_ids), len(ids), len(levels)) + body


class Segment:
    """Random access to a segment through ``read(offset, length)``; only what is asked for is read."""

    def __init__(self, read: Callable[[int, int], bytes], at: int = 0):
        self._read, self.at = read, at
        magic, self.length, self.n_docs, self.n_tokens, n_levels = _HEAD.unpack(read(at, _HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        pos = at + _HEAD.size
        self.sizes = struct.unpack(f"<{n_levels}Q", read(pos, 8 * n_levels))
        self._docs = pos = pos + 8 * n_levels
        self._nulls = pos = pos + 8 * self.n_docs
        self._starts = pos = pos + self.n_docs + -self.n_docs % 8
        pos += 8 * (self.n_docs + 1)
        self._levels = []
        for n in self.sizes:
            bits = pos + n + -n % 8
            ranks = bits + 8 * (-(-n // 64))
            self._levels.append((pos, bits, ranks))
            pos = ranks + 8 * (-(-n // 512) + 1)

    def docs(self) -> tuple[list[int | None], np.ndarray]:
        """The document ids and where the ids of each begin (one more at the end)."""
        ids = np.frombuffer(self._read(self._docs, 8 * self.n_docs), "<i8").tolist()
        nulls = self._read(self._nulls, self.n_docs)
        return [None if null else d for d, null in zip(ids, nulls)], np.frombuffer(
            self._read(self._starts, 8 * (self.n_docs + 1)), "<u8").astype(np.int64)

    def _bits(self, level: int, lo: int, hi: int) -> np.ndarray:
        """Continuation bits ``lo`` to ``hi`` of a level, by whole words."""
        first, last = lo // 64, -(-hi // 64)
        words = self._read(self._levels[level][1] + 8 * first, 8 * (last - first))
        return np.unpackbits(np.frombuffer(words, np.uint8), bitorder="little")[lo - 64 * first:hi - 64 * first]

    def _rank(self, level: int, i: int) -> int:
        """Ones before position ``i``: a directory entry and at most 512 bits."""
        block = i // 512
        before = struct.unpack("<Q", self._read(self._levels[level][2] + 8 * block, 8))[0]
        return before + (int(self._bits(level, 512 * block, i).sum()) if i % 512 else 0)

    def token(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, level = 0, 0
        while True:
            value |= self._read(self._levels[level][0] + i, 1)[0] << (8 * level)
            if not self._bits(level, i, i + 1)[0]:
                return value
            i, level = self._rank(level, i), level + 1

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """The ids at positions ``lo`` to ``hi``, by one run of chunks per level."""
        out = np.zeros(hi - lo, np.uint32)
        where, level = np.arange(hi - lo), 0
        while len(where):
            chunks = np.frombuffer(self._read(self._levels[level][0] + lo, hi - lo), np.uint8)
            out[where] |= chunks.astype(np.uint32) << np.uint32(8 * level)
            on = self._bits(level, lo, hi).astype(bool)
            where = where[on]
            if len(where):
                lo = self._rank(level, lo)
                hi, level = lo + len(where), level + 1
        return out


def segments(uri: str) -> Iterator[Segment]:
    """The segments of a file in turn."""
    with open_file(uri) as f:
        def read(at: int, n: int) -> bytes:
            f.seek(at)
            return f.read(n)

        at, end = 0, f.size()
        while at < end:
            s = Segment(read, at)
            yield s
            at += s.length


# ---------------------------------------------------------------- tokenizer
class _Encoder:
    """The tokenizers library behind a memory of chunks.

    Where the file asks for plain byte-level pieces, a piece unknown so far goes
    to the library's model alone; any other file, and any text that holds an
    added token, goes through the library as a whole.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        import json
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.plain = (spec.get("normalizer") is None and split.get("type") == "ByteLevel"
                      and not split.get("add_prefix_space") and split.get("use_regex", True))
        self.added = [t["content"] for t in spec.get("added_tokens") or ()]
        self.letters = self._byte_letters()
        self.pattern = regex.compile(pattern)
        self.pieces = Generations(self._piece, 1 << 19)
        self.chunks = ChunkEncoder(lambda text: b"".join(map(self.pieces.__getitem__, self.pattern.findall(text))), 1 << 19)

    @staticmethod
    def _byte_letters() -> dict[int, str]:
        """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest from U+0100 on."""
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _piece(self, piece: str) -> bytes:
        word = piece.encode().decode("latin-1").translate(self.letters)
        return _bytes([t.id for t in self.tok.model.tokenize(word)])

    def __call__(self, text: str) -> bytes:
        if self.plain and not any(a in text for a in self.added):
            return self.chunks(text)
        return _bytes(self.tok.encode(text, add_special_tokens=False).ids)


def _bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers; much quicker than numpy for a few."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


_LOADED: dict[tuple[str, str], _Encoder] = {}


def load(path: str, pattern: str) -> _Encoder:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = _Encoder(path, pattern)
    return _LOADED[path, pattern]


# ---------------------------------------------------------------- operators
def write(df: DataFrame, out: str, path: str, pattern: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text", segment_tokens: int = 1 << 20) -> None:
    """Tokenise every text, append ``end_id``, and write the ids to ``out`` in ascending id order.

    Rows are range-partitioned and sorted by id (nulls first; equal ids by text),
    so file names and segments follow the id order.  A null or empty text has the
    end id alone.  No rows write no segment.  Other columns are left out.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def make():
        encode = load(path, pattern)
        held: list = []  # of one segment
        size = [0]

        def flush():
            ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
            starts = np.cumsum([0] + [len(x) // 4 for _, x in held])
            row = segment([d for d, _ in held], ids, starts)
            held.clear()
            size[0] = 0
            return pa.RecordBatch.from_arrays([pa.array([row[:-1]], pa.binary())], ["segment"])

        def step(batch):
            for d, t in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                held.append((d, encode(t) + tail))
                size[0] += len(held[-1][1]) // 4
                if size[0] >= segment_tokens:
                    yield flush()

        step.close = lambda: [flush()] if held else []
        return step

    rows = (df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
              .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    write_bytes(map_rows(rows, "segment binary", make), "segment", out, END)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, segment, doc_id, start, n_tokens, ids_crc32) of every document in the files below ``path``.

    ``start`` counts from the beginning of the file.
    """
    names = ["file", "segment", "doc_id", "start", "n_tokens", "ids_crc32"]

    def make():
        def step(batch):
            for uri in batch.column(0).to_pylist():
                before = 0
                for s in segments(uri):
                    docs, starts = s.docs()
                    ends = starts[1:]
                    crc = [zlib.crc32(s.slice(a, b).astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                    n = s.n_docs
                    yield pa.RecordBatch.from_arrays([
                        pa.array([uri] * n), pa.array([s.at] * n, pa.int64()), pa.array(docs, pa.int64()),
                        pa.array(starts[:-1] + before, pa.int64()), pa.array(ends - starts[:-1], pa.int64()),
                        pa.array(crc, pa.int64())], names)
                    before += s.n_tokens
        return step

    found = list_files(spark, path).filter("length > 0")
    files = found.repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    return map_rows(files.select("path"), "file string, segment bigint, doc_id bigint, start bigint, "
                    "n_tokens bigint, ids_crc32 bigint", make, slice_rows=1)


def positions(docs: DataFrame) -> DataFrame:
    """doc_id, start (over all files in id order), n_tokens, ids_crc32 from the rows of ``read``.

    Files hold disjoint id ranges; the running total is over one row per file.
    """
    docs = stage(docs, "token-docs")
    per_file = docs.groupBy("file").agg(F.min("doc_id").alias("first"), F.sum("n_tokens").alias("n"))
    order = Window.orderBy(F.col("first").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    before = per_file.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return (docs.join(sized(stage(before, "token-files"), 256), "file")
                .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))
