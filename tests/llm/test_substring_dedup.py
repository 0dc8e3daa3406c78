import hashlib
import random

import numpy as np
import pytest

from tallyspark.llm import substring_dedup as sd


def brute(rows, window=50):
    """Rows (id, words, removed, digest), ids given in any order, repeated ids judged apart."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                s = tuple(w[k:k + window])
                least[s] = min(i, least.get(s, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if least[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)] + ["É", "ß."]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [draw(rng.choice([49, 50, 51, 60, 120, 400])) for _ in range(8)] + [["same"] * 70, ["a", "b"] * 45]
    rows = []
    for i in range(60):
        w = draw(rng.choice([0, 3, 30, 200]))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            lo = rng.choice([0, 0, 1, 5])
            w += p[lo:len(p) - rng.choice([0, 0, 2])] + draw(rng.choice([0, 1, 40]))
        rows.append((rng.randrange(10_000), rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(20_000 + k, rows[k][1]) for k in range(0, 60, 9)]
    return rows


@pytest.mark.parametrize("hot", [16384, 4, 0])
def test_like_all_windows(make_docs, monkeypatch, hot):
    rows = corpus(hot)
    real = sd.repeats
    monkeypatch.setattr(sd, "repeats", lambda docs, window: real(docs, window, group_rows=hot))
    monkeypatch.setattr(sd, "TREE_WORDS", 500)
    assert sorted(map(tuple, sd.digest(make_docs(rows)).collect()), key=str) == brute(rows)


def test_odd_rows(make_docs):
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [(3, long), (1, long[5000:90_000]), (2, None), (4, ""), (None, long), (5, "few words"), (6, "few words"), (3, long), (3, "other " * 60), (7, "other " * 55)]
    assert sorted(map(tuple, sd.digest(make_docs(rows)).collect()), key=str) == brute(rows)
    assert sd.digest(make_docs([])).count() == 0


def test_nodes_at_depth_are_equal_windows():
    x = np.random.default_rng(1).integers(0, 2, 400)
    for depth in (1, 2, 7, 50):
        node = sd.node_at_depth(x, depth)[:400 - depth + 1]
        strings = [tuple(x[i:i + depth]) for i in range(400 - depth + 1)]
        assert len({*zip(node.tolist(), strings)}) == len(set(strings)) == len(set(node.tolist()))
