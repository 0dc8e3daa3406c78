import random

import pytest

from tallyspark.llm import decontaminate as dc


def word_set(t):
    w = (t or "").split()
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in w]
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.mark.parametrize("limit", [None, 0])
def test_like_brute_force(spark, make_docs, monkeypatch, limit):
    if limit is not None:  # the shuffle joins
        monkeypatch.setattr(dc, "sized", lambda df, n: df)
        monkeypatch.setattr(dc, "sized_lists", lambda df, c, n: df)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 9, 20, 33, 64, 90])))) for i in range(30)]
    items += [(100, None), (101, ""), (None, items[0][1]), (5, "another text for item five with words")]
    docs = []
    for i in range(80):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 40, 400]))]
        t = (items[rng.randrange(30)][1] or "").split()
        for _ in range(rng.randint(0, 4)):
            if t:
                t[rng.randrange(len(t))] = "edit"
        at = rng.randrange(len(w) + 1)
        docs.append((i, "\n ".join(w[:at] + (t if rng.random() < .7 else []) + w[at:]).upper()))
    docs += [(90, None), (91, ""), (None, items[3][1]), (92, items[7][1]), (92, "one more row of 92"), (93, items[7][1] + " x" * 30000)]
    held, wanted = {}, {}
    for i, t in docs:
        if i is not None:
            held.setdefault(i, set()).update(word_set(t))
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(word_set(t))
    want = sorted((d, i, len(y), len(x & y)) for d, x in held.items() for i, y in wanted.items() if y and 100 * len(x & y) >= 75 * len(y))
    got = sorted(map(tuple, dc.search(make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS n", "2 AS key")).collect()))
    assert got == want and want


def test_an_item_split_over_two_rows_of_an_id(spark, make_docs):
    words = [f"w{i}" for i in range(44)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    docs = make_docs([(7, " ".join(words[:22])), (7, " ".join(words[22:])), (8, " ".join(words[:22])), (9, " ".join(words))])
    assert sorted(map(tuple, dc.search(docs, items).collect())) == [(7, 1, 40, 36), (9, 1, 40, 40)]


def test_clean_and_no_rows(spark, make_docs):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id bigint, text string")
    docs = make_docs([(1, "x one two three four five six seven y"), (2, "x y z"), (None, "one two three four five six seven"), (3, None)])
    left = dc.clean(docs, items)
    assert left.columns == docs.columns and sorted((r.doc_id or 0) for r in left.collect()) == [0, 2, 3]
    assert dc.search(make_docs([]), items).count() == 0
    assert dc.clean(docs, items.limit(0)).count() == 4


def test_no_python_in_the_plan(spark, make_docs):
    df = dc.search(make_docs([(1, "a b c d e f")]), spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string"))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
