import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tallyspark.llm import periodic_runs as pr


def brute(w):
    """(start, length, period) of all runs, by the definition."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(
                    all(w[a] == w[a + d] for a in range(i, j + q - d)) for d in range(1, q)):
                out[i, q] = (i, j + q - i, q)
            i = j
    return [out[k] for k in sorted(out)]


def numbers(words):
    seen = {}
    return np.array([seen.setdefault(x, len(seen)) for x in words], np.int64)


def sample(rng):
    words = []
    for _ in range(rng.integers(1, 6)):
        kind = rng.integers(0, 4)
        if kind == 0:
            words += rng.integers(0, 50, rng.integers(0, 80)).tolist()
        elif kind == 1:
            words += rng.integers(0, 2, rng.integers(0, 60)).tolist()
        else:
            q = int(rng.integers(1, 70))
            unit = rng.integers(0, [2, 500][kind - 2], q).tolist()
            words += (unit * 7)[:int(rng.integers(2 * q, 6 * q + 1))]
    return words


def test_like_the_definition():
    rng = np.random.default_rng(1)
    docs = [sample(rng) for _ in range(150)] + [[], [7], [7] * 5, [7] * 6, [1, 2] * 4, [1, 2] * 4 + [1], list("abaab" * 40)]
    fib = "a", "ab"
    while len(fib[1]) < 400:
        fib = fib[1], fib[1] + fib[0]
    docs += [list(fib[1]), list(range(33)) * 4, list(range(16)) * 9, list(range(15)) * 9, list(range(64)) * 4, list(range(64)) * 4 + [0]]
    docs += [list(range(200)) * 3 + list(range(199)), list(range(200)) * 4, ([1] * 20 + [2]) * 5, ([1, 2] * 30 + [3]) * 6]
    want = [brute(d) for d in docs]
    assert sum(map(len, want)) > 250 and sum(q >= 16 for r in want for *_, q in r) > 60
    assert pr.find([numbers(d) for d in docs]) == want
    for d, r in zip(docs, want):                            # alone as in company
        assert pr.find([numbers(d)]) == [r]


@pytest.mark.parametrize("direct", [1, 2, 64])
def test_scales_and_lag_scans_agree(monkeypatch, direct):
    rng = np.random.default_rng(direct)
    docs = [numbers(sample(rng)) for _ in range(60)]
    want = pr.find(docs)
    monkeypatch.setattr(pr, "DIRECT", direct)
    assert pr.find(docs) == want


def test_long_documents_and_long_periods():
    rng = np.random.default_rng(3)
    unit = rng.integers(0, 10 ** 6, 5000)
    doc = np.concatenate([rng.integers(0, 10 ** 6, 777), np.tile(unit, 5)[:21000], [-0], np.full(9000, 4)])
    got = pr.find([doc])[0]
    assert (777, 21000, 5000) in got and any(n >= 9000 and q == 1 for _, n, q in got) and len(got) == 2


def expected(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if i is not None and n and zlib.crc32(str(i).encode()) % 10 == 0:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[j if j < a else a + (j - a) % p] for j in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {j for s, m, q in runs for j in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for j, w in enumerate(words) if j not in gone)))


def test_query_rows_like_the_definition(spark, make_docs):
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(f"w{x}é" for x in sample(rng))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, " \t\n\x0b\x0c\r "), (203, "a b c a b c " * 6), (None, "x y " * 9),
              (205, "the same words again " * 500), (-3, "z " * 8), (5, "again again"), (5, "x " * 7)]
    got = sorted((tuple(r) for r in pr.digest(make_docs(texts)).collect()), key=repr)
    assert got == sorted((expected(i, t) for i, t in texts), key=repr)


def test_registered_query_on_a_given_table(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in rows if len((r.text or "").split()) <= 400}
    got = E.queries()["op13_periodic_runs"](spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(got) == len(rows) and {i: got[i] for i in short} == {i: expected(i, t) for i, t in short.items()}


def test_operator_gives_texts_and_runs(spark, make_docs):
    rows = pr.periodic_runs(make_docs([(1, "go " * 9 + "home"), (1, "go " * 9 + "home"), (2, None)])).collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in rows] == [
        (1, 10, [(0, 9, 1)], b"go home")] * 2 + [(2, 0, [], b"")]
    assert pr.periodic_runs(make_docs([])).count() == 0
