import numpy as np

from tallyspark.llm import common, quality as q

SF = "/root/testdata/sf0.1"


def test_against_the_true_labels(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    got = {r.doc_id: r for r in q.classify(docs).collect()}
    assert len(got) == docs.count()
    pairs = [(got[r.doc_id].keep, bool(r.quality)) for r in labels.collect()]
    assert sum(a == b for a, b in pairs) / len(pairs) > .99
    good = [a for a, b in pairs if b]
    assert sum(good) / len(good) > .995  # clean documents stay


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < .85
    right = [.95, .9, .9, .85, .97]
    patterns: dict[str, int] = {}
    rows = []
    for t in truth:
        p = "".join("-" if rng.random() < .2 else str(int(t == (rng.random() < a))) for a in right)
        patterns[p] = patterns.get(p, 0) + 1
        rows.append(p)
    post = q.label_model(patterns)
    assert np.mean([(post[p] > .5) == t for p, t in zip(rows, truth)]) > .97
    assert q.label_model({}) == {}


def test_odd_rows(make_docs):
    plain = "The river ran past the old mill, and nobody in the village knew when it was built. "
    rows = [(i, plain + f"It was day {i} of the month, and rain fell on the hills.") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "   "), (None, plain), (103, "BUY!! NOW!! " * 80), (104, "a### b*** c%%% dd&&& " * 40), (105, plain * 2000), (105, plain * 2000)]
    docs = make_docs(rows)
    got = q.classify(docs).collect()
    assert len(got) == len(rows)
    assert all(r.quality_score == 0 and not r.keep for r in got if r.doc_id in (100, 101, 102))
    left = q.keep_good(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert {*range(60)} <= set(ids) and not {100, 101, 102} & set(ids) and None in ids
    assert q.classify(make_docs([])).count() == 0 and q.keep_good(make_docs([])).count() == 0


def _plain_em(patterns, rounds=200):
    """The label model with dictionaries and loops."""
    import math
    belief = {p: .1 if p.count("0") >= 2 else .9 for p in patterns}
    total = sum(patterns.values())
    for _ in range(rounds):
        prior = (sum(k * belief[p] for p, k in patterns.items()) + 1) / (total + 2)
        rate = []
        for i in range(12):
            good, bad = {"0": 1.0, "1": 1.0}, {"0": 1.0, "1": 1.0}
            for p, k in patterns.items():
                if p[i] != "-":
                    good[p[i]] += k * belief[p]
                    bad[p[i]] += k * (1 - belief[p])
            rate.append({v: math.log(good[v] / sum(good.values()) / (bad[v] / sum(bad.values()))) for v in "01"})
        new = {}
        for p in patterns:
            z = math.log(prior / (1 - prior)) + sum(rate[i][v] for i, v in enumerate(p) if v != "-")
            new[p] = 1 / (1 + math.exp(-max(-50, min(50, z))))
        moved, belief = max(abs(new[p] - belief[p]) for p in belief), new
        if moved < 1e-9:
            break
    return belief


def test_query_like_plain_python(spark):
    """Votes counted, the label model and the scorer anew: loops, a dense matrix and Newton steps."""
    from collections import Counter
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    votes = {i: q.votes(q.statistics(t)) for i, t in texts.items()}
    posterior = _plain_em(Counter(votes.values()))
    distinct = sorted(set(texts.values()))
    features = q.Features()
    sparse = [features(t, q.statistics(t)) for t in distinct]
    used = sorted({c for x in sparse for c in x})
    x = np.zeros((len(distinct), len(used) + 1))
    x[:, -1] = 1
    for r, row in enumerate(sparse):
        for c, v in row.items():
            x[r, used.index(c)] = v
    y = np.array([posterior[q.votes(q.statistics(t))] for t in distinct])
    w, ridge = np.zeros(x.shape[1]), np.r_[np.full(len(used), 1e-4), 1e-12]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        h = x.T @ (x * (p * (1 - p))[:, None]) / len(y) + np.diag(ridge + 1e-9)
        w -= np.clip(np.linalg.solve(h, x.T @ (p - y) / len(y) + ridge * w), -5, 5)
    score = {t: (1 / (1 + np.exp(-np.clip(z, -50, 50))) if t.split() else 0.0) for t, z in zip(distinct, x @ w)}
    got = {r.doc_id: r for r in E.queries()["op10_quality"](spark, sf).collect()}
    assert set(got) == set(texts)
    assert all(abs(got[i].weak_label - posterior[votes[i]]) < 1e-6 for i in texts)
    assert all(r.keep == (r.quality_score >= .5) for r in got.values())
    far = [i for i in texts if abs(score[texts[i]] - .5) > .25]
    assert len(far) > .9 * len(texts)
    assert all(got[i].keep == (score[texts[i]] >= .5) for i in far)
