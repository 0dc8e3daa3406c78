import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tallyspark.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ours = bpe.load(PATH, P.PATTERN)
    return ours, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def _ids(ours, text):
    return np.frombuffer(ours.text_ids(text), "<u4").tolist()


def test_like_tiktoken_on_random_texts(both):
    ours, ref = both
    rng = random.Random(5)
    letters = list("aab bcd ee  \n\t.,'s123 éü漢字  \x1c\u0085　😀")
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert _ids(ours, t) == ref.encode_ordinary(t), t


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "=" * 777, "thisisaverylongword" * 200, "!" * 1001 + "?" * 37,
                                  " " * 999, "\n" * 333 + "x", "0" * 1234, "é" * 500, "", " ", "<|endoftext|>"])
def test_long_pieces(both, text):
    ours, ref = both
    assert _ids(ours, text) == ref.encode_ordinary(text)
    assert ours.decode(_ids(ours, text)) == text.encode()


def test_join_is_the_encoding_of_the_concatenation(both):
    ours, _ = both
    rng = random.Random(6)
    for _ in range(2000):
        x, y = (bytes(rng.choice(b"aabcde st\xc3\xa9") for _ in range(rng.randint(0, 30))) for _ in range(2))
        assert ours.join(ours.merge(x), ours.merge(y)) == ours.merge(x + y)
        assert ours.encode_piece(x + y) == ours._merge_heap(x + y)


def test_rows(make_docs, both):
    _, ref = both
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "x"), (4, "dup"), (4, "dup"), (5, "word " * 30000)]
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in bpe.round_trip(make_docs(rows), PATH, P.PATTERN).collect())
    want = []
    for i, t in rows:
        ids = np.array(ref.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i is None, i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(make_docs([]), PATH, P.PATTERN).count() == 0
    assert base64.b64decode(b"IQ==") in both[0].ranks
