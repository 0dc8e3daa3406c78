import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from tallyspark.llm import token_store as ts
from tallyspark.session import scratch_path

PATH = P.path("byte_bpe_50k.json")


def test_random_access_to_any_token():
    rng = np.random.default_rng(1)
    for top in (2, 256, 50257, 1 << 20, 1 << 32):
        ids = rng.integers(0, top, 3000).astype(np.uint32)
        starts = np.array([0, 0, 1000, 3000])
        data = ts.segment([7, None, 9], ids, starts)
        assert data[-1:] == ts.END
        reads = []

        def read(at, n):
            reads.append(n)
            return data[at:at + n]

        s = ts.Segment(read)
        assert s.length == len(data) and s.docs()[0] == [7, None, 9]
        reads.clear()
        assert [s.token(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
        assert max(reads) <= 64 and len(reads) < 6 * 4 * 429  # a block of the bitmap at most, per level
        for lo, hi in ((0, 3000), (511, 513), (1000, 1000), (63, 2049)):
            assert s.slice(lo, hi).tolist() == ids[lo:hi].tolist()
    empty = ts.Segment(lambda at, n, d=ts.segment([], np.empty(0, np.uint32), np.zeros(1)): d[at:at + n])
    assert empty.n_tokens == 0 and empty.docs()[0] == []


def test_files(spark, make_docs):
    tok = Tokenizer.from_file(PATH)
    rows = [(5, "Hello  world \n x"), (2, None), (3, ""), (9, "it's <|endoftext|> here"), (4, "é" * 700), (-1, "word " * 20000), (9, "z")]
    out = scratch_path(spark, "ids")
    ts.write(make_docs(rows), out, PATH, P.PATTERN, segment_tokens=100)
    got = sorted(map(tuple, ts.positions(ts.read(spark, out)).collect()))
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == sorted(want)


def test_null_id_and_no_rows(spark, make_docs):
    out = scratch_path(spark, "ids")
    ts.write(make_docs([(None, "a b"), (1, "c")]), out, PATH, P.PATTERN)
    assert sorted((r.doc_id or 0, r.start, r.n_tokens) for r in ts.positions(ts.read(spark, out)).collect()) == [(0, 0, 3), (1, 3, 2)]
    out = scratch_path(spark, "ids")
    ts.write(make_docs([]), out, PATH, P.PATTERN)
    assert ts.positions(ts.read(spark, out)).count() == 0
