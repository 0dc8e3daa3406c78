import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import common, toxicity as tx

SF = "/root/testdata/sf0.1"


def test_viterbi_is_the_cheapest_reading():
    rng = np.random.default_rng(2)
    r = tx.Restorer(rng.random((64, 64, 64)) * 5)

    def readings(word, before=""):
        if not word:
            yield [], 0.0
            return
        ch = word[0]
        options = [(c, tx.SWAP) for c in tx.LEET.get(ch, "")]
        if ch.isalpha():
            options.append((ch, 0.0))
            if ch == before:
                options.append(("", tx.REPEAT))
        else:
            options.append(("", tx.REPEAT if ch == before else tx.SKIP_LEET if ch in tx.LEET else tx.SKIP))
        for rest, cost in readings(word[1:], ch):
            for c, price in options:
                yield [c, *rest], cost + price

    def cost(chars, channel):
        a = b = 0
        for c in filter(None, chars):
            i = tx._INDEX.get(c, tx._OTHER)
            a, b, channel = b, i, channel + r.costs[a][b][i]
        return channel + r.costs[a][b][0]

    draw = random.Random(1)
    for _ in range(300):
        word = "".join(draw.choice("ab1|0$.e") for _ in range(draw.randint(1, 7)))
        best = min(cost(c, k) for c, k in readings(word))
        chosen = r.viterbi(word)
        assert min(cost(c, k) for c, k in readings(word) if "".join(c) == chosen) == pytest.approx(best)


def test_restores_what_the_corpus_writes(spark):
    model = tx.language_model(tx.trigram_counts(common.table(spark, SF, "documents")))
    r = tx.Restorer(model)
    for hidden, word in {"m0r0n": "moron", "p@thetic": "pathetic", "l0ser": "loser", "i.d.i.o.t": "idiot", "stuuuupid": "stupid",
                         "cl0wn": "clown", "tr@sh": "trash", "moron###": "moron", "(idiot!!": "idiot", "2024": "2024", "plain,": "plain"}.items():
        assert r(hidden) == word
    assert "idiot" in r.words("you i d i o t you", {w: w for w in "you i d o t".split()})


def test_held_out_accuracy_and_hidden_words(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    got = {r.doc_id: r for r in tx.score(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(got[r.doc_id], r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    right = sum(g.predicted == t for g, t in held)
    assert right / len(held) > .97
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= .3) for g in got.values())


def test_held_out_toxic_rows_are_found_in_every_language(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    got = (tx.score(docs, labels).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id")
             .join(docs.select("doc_id", "lang"), "doc_id").groupBy("lang").agg(
                 F.expr("count_if(toxic = 1)"), F.expr("count_if(toxic = 1 and predicted = 1)"),
                 F.expr("count_if(toxic = 0)"), F.expr("count_if(toxic = 0 and predicted = 1)")).collect())
    print(sorted(got))
    toxic, found, clean, flagged = (sum(r[i] for r in got) for i in range(1, 5))
    assert found / toxic > .9 and flagged / clean < .02
    assert all(r[2] / r[1] > .75 for r in got if r[1])


def test_neutral_features_weigh_nothing_in_crowded_tables(monkeypatch):
    """A few frequent words set the mean of a bucket; a feature rarer than that mean must not pass as one that no clean document holds."""
    monkeypatch.setattr(tx, "BITS", 12)
    rng, n_clean, n_toxic = np.random.default_rng(5), 20000, 1000
    names = [f"common{i}" for i in range(200)] + [f"rare{i}" for i in range(2000)]
    rate = np.array([.1] * 200 + [.006] * 2000)
    counts = np.zeros((2, tx.ROWS << tx.BITS), np.int64)
    at = tx._buckets(np.array([tx.features(w)[0] for w in names], np.uint64))
    telling = tx._buckets(np.array(tx.features("moron")[:1], np.uint64))
    for label, n in ((0, n_clean), (1, n_toxic)):
        held = rng.poisson(rate * n)
        for row in at:
            np.add.at(counts[label], row, held)
    counts[1, telling[:, 0]] += 300
    weigh = tx.Weigher(counts.astype(np.uint32), np.array([n_clean, n_toxic]))
    assert not any(map(weigh, names)) and weigh("moron") > 0


def test_odd_rows(spark, make_docs):
    rows = [(i, "you are a fool " + "x" * (i % 5)) for i in range(0, 400, 2)] + [(i, f"a fine day number{i}") for i in range(1, 400, 2)]
    rows += [(500, None), (501, ""), (None, "you fool"), (502, "fool"), (502, "fool"), (503, "f00l"), (504, "a " * 50000)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(400)] + [(501, None), (None, 1), (1, 7), (2, 1)], "doc_id bigint, toxic int")
    got = tx.score(make_docs(rows), labels.selectExpr("*", "'t' AS text", "0 AS quality")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[502].predicted == by[503].predicted == by[None].predicted == 1
    assert by[500].score == by[501].score < .3 and by[504].predicted == 0 and by[None].held_out is False
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    empty = make_docs([])
    assert tx.score(empty, labels).count() == 0
    assert {r.predicted for r in tx.score(make_docs(rows[:9]), labels.limit(0)).collect()} <= {0, 1}
