import random

import pytest

from tallyspark.llm import jaccard_join as jj


def word_set(t):
    w = [x.lower() for x in (t or "").encode().split()]
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """doc_id -> (set size, component); ids are unique."""
    sets = {i: word_set(t) for i, t in rows}
    comp = {i: i for i in sets}
    near = {i: [j for j, y in sets.items() if j != i and x and y and 100 * len(x & y) >= 75 * len(x | y)] for i, x in sets.items()}
    while True:
        new = {i: min([comp[i], *(comp[j] for j in near[i])]) for i in comp}
        if new == comp:
            return {i: (len(sets[i]), comp[i]) for i in comp}
        comp = new


def corpus(seed):
    """Families of edited copies of all sizes, with a common passage in most of them."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 17, 20, 24, 30, 40, 80, 300] * 3:
        first = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(rng.randint(1, 6)):
            words = list(first)
            for _ in range(rng.randint(0, max(1, size // 14))):
                at = rng.randrange(len(words))
                words[at:at + 1] = rng.choice([[], [rng.choice(vocabulary)], [words[at], "x"]])
                if not words:
                    words = ["x"]
            if size >= 40 and rng.random() < .6:
                words += common
            text = rng.choice([" ", "\n", "\t  "]).join(words)
            rows.append((len(rows) * 3 + 1, text.upper() if rng.random() < .1 else text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("boundary, block", [(None, None), (0, None), (12, 3), (4, 2)])
def test_like_all_pairs(make_docs, monkeypatch, boundary, block):
    rows = corpus(boundary or 50)
    if boundary is not None:
        monkeypatch.setattr(jj, "_boundary", lambda groups, counts: boundary)
    if block:
        monkeypatch.setattr(jj, "LIST_BLOCK", block)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.components_of(make_docs(rows)).collect()}
    assert got == brute(rows)


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (None, "a b"), (6, "c d e f g h"), (6, "c d e f g h"),
            (7, "a b c"), (8, "q " * 30000), (9, "q " * 29000)]
    got = sorted(map(tuple, jj.components_of(make_docs(rows)).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (None, 1, None), (6, 2, 6), (6, 2, 6), (7, 1, 7),
                          (8, 1, 8), (9, 1, 8)], key=str)
    docs = make_docs(rows)
    kept = jj.keep_one(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert jj.components_of(make_docs([])).count() == 0 and jj.keep_one(make_docs([])).count() == 0


def test_sizes_of_partners_and_subsets():
    for s in range(1, 40):
        linked = [t for t in range(1, 80) if any(100 * k >= 75 * (s + t - k) for k in range(min(s, t) + 1))]
        assert jj.partner_sizes(s) == linked
        for t in linked:
            assert jj.least_overlap(s, t) == min(k for k in range(min(s, t) + 1) if 100 * k >= 75 * (s + t - k))
