"""Operator 2: byte-level BPE encoding and decoding by monoid tree reduction.

Encoding a piece halves it recursively; two encoded neighbours are joined by
re-encoding a window around the boundary.  The window grows until the tokens
just outside it provably stay: greedy merging never crosses the boundary of two
adjacent tokens ``x, y`` exactly when encoding the bytes of ``x + y`` gives
``[x, y]`` back, and a token sequence in which every adjacent pair passes that
test is the encoding of its bytes (the first merge across a boundary would also
be the first one in the pair alone).  So a join only has to test the two pairs
at the window's edges.  Decoding concatenates token bytes up the same tree.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .chunks import ChunkEncoder, Generations
from .common import kept, map_rows, texts

#: Strings up to this many bytes are merged directly; longer ones are halved.
LEAF_BYTES = 4
#: Strings up to this many bytes are remembered, as are the results of windows of that size.
SHORT_BYTES = 12


class Bpe:
    """Ranks of a byte-level vocabulary with tree encoding and decoding."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.fits = lru_cache(1 << 17)(self._fits)
        self._short_merge, self._short_tree = lru_cache(1 << 16)(self._merge_plain), lru_cache(1 << 16)(self._halve)
        self.pieces = Generations(self._piece, 1 << 14)
        self.text_ids = ChunkEncoder(self._pieces, 1 << 17)

    # ------------------------------------------------------------- merging
    def merge(self, data: bytes) -> list[int]:
        """Greedy merges: always the lowest rank, leftmost first."""
        if len(data) <= SHORT_BYTES:
            return self._short_merge(data)
        return self._merge_plain(data) if len(data) <= 64 else self._merge_heap(data)

    def _merge_plain(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        parts = [data[i:i + 1] for i in range(n)]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _merge_heap(self, data: bytes) -> list[int]:
        """The same merges in n log n, for long windows."""
        ranks, n = self.ranks, len(data)
        end, prev = list(range(1, n + 1)), list(range(-1, n - 1))  # part i is data[i:end[i]]; the next part starts at end[i]
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := prev[i]) >= 0 and (r := ranks.get(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return [ranks[data[i:end[i]]] for i in range(n) if alive[i]]

    # ---------------------------------------------------------------- tree
    def _fits(self, x: int, y: int) -> bool:
        return self.merge(self.tokens[x] + self.tokens[y]) == [x, y]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's product: the encoding of the concatenated bytes."""
        if not left or not right:
            return left or right
        if self.fits(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[len(left) - i:] + right[:j])))
            ok_left = i == len(left) or self.fits(left[-i - 1], window[0])
            ok_right = j == len(right) or self.fits(window[-1], right[j])
            if ok_left and ok_right:
                return left[:len(left) - i] + window + right[j:]
            if not ok_left:
                i = min(2 * i, len(left))
            if not ok_right:
                j = min(2 * j, len(right))

    def encode_piece(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        return self._short_tree(data) if len(data) <= SHORT_BYTES else self._halve(data)

    def _halve(self, data: bytes) -> list[int]:
        middle = len(data) // 2
        return self.join(self.encode_piece(data[:middle]), self.encode_piece(data[middle:]))

    def decode(self, ids: list[int]) -> bytes:
        """Token bytes, concatenated pairwise up the tree."""
        parts = [b"".join(map(self.tokens.__getitem__, ids[i:i + 4096])) for i in range(0, len(ids), 4096)]
        while len(parts) > 1:
            parts = [b"".join(parts[i:i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""

    # --------------------------------------------------------------- texts
    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        return np.array([whole] if whole is not None else self.encode_piece(data), dtype="<u4").tobytes()

    def _pieces(self, text: str) -> bytes:
        """Ids of a text piece by piece; a word after a space is remembered once, as the chunk that it is."""
        found = self.pattern.findall(text)
        if len(found) == 1:
            return self._piece(found[0])                     # the caller remembers chunks
        words, others = self.text_ids.rest, self.pieces
        return b"".join([words[p[1:]] if p[0] == " " and p[1:].isalpha() else others[p] for p in found])


def load(path: str, pattern: str) -> Bpe:
    """The vocabulary in a rank file (base64 token, rank), loaded once for the tasks that a worker runs in a row."""
    def make():
        with open(path, "rb") as f:
            return Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)
    return kept(("bpe", path, pattern), make)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian unsigned 32-bit integers in one binary.

    A null or empty text has no tokens; a null id is kept; repeated rows each give
    their row; other columns are left out, whatever their names.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        bpe = load(path, pattern)

        def step(batch):
            ids = [bpe.text_ids(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                [id_col, "n_tokens", "ids"])
        return step

    return map_rows(df.select(id_col, text_col), f"`{id_col}` {kind}, n_tokens bigint, ids binary", make)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary): the bytes that the ids stand for; null ids give null.

    A column ``decoded`` of ``df`` is replaced.
    """
    df = df.select(*(c for c in df.columns if c != "decoded"))
    names = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def make():
        bpe = load(path, pattern)

        def step(batch):
            out = [None if x is None else bpe.decode(np.frombuffer(x, dtype="<u4").tolist())
                   for x in batch.column(names.index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*names, "decoded"])
        return step

    return map_rows(df, f"{schema}, decoded binary", make)


def encode_decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded): ``encode`` and ``decode`` of its ids by one Python worker a task, as the two alone would give."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        bpe = load(path, pattern)

        def step(batch):
            ids = [bpe.text_ids(t) for t in texts(batch.column(1))]
            out = [bpe.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                              pa.array(ids, pa.binary()), pa.array(out, pa.binary())], [id_col, "n_tokens", "ids", "decoded"])
        return step

    return map_rows(df.select(id_col, text_col), f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded binary", make)


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again.

    A null or empty text has no tokens and the digest of no bytes; repeated rows give a row each, a null id
    stays null; an empty table gives no rows; a text of any length is taken whole.
    """
    both = encode_decode(df, path, pattern)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
