import hashlib

import duckdb
import pyarrow.parquet as pq

import corpus_pipeline as cp
from tallyspark.llm import common, decontaminate, jaccard_join, pii, quality
from tests.llm.test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


def test_like_brute_force(spark):
    """Each later stage anew, in plain Python over the rows that the classifier keeps."""
    docs = common.table(spark, SF, "documents")
    good = {r.doc_id: r.text for r in quality.keep_good(docs).collect()}
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert sum((i in good) == bool(k) for i, k in labels.items()) >= .95 * len(labels)
    one = [i for i, (_, c) in brute(list(good.items())).items() if c == i]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    con.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    seen = {r[0] for r in con.sql(decontaminate.SQL).fetchall()}
    f = pii.Finder()
    want = {i: hashlib.sha256(pii.mask(good[i], f.spans(good[i])).encode()).hexdigest() for i in one if i not in seen}
    got = cp.run(spark, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == want and len(got) == len(want)


def test_stages_keep_the_columns(spark, make_docs):
    docs = common.table(spark, SF, "documents")
    for name, apply in cp.STAGES[:-1]:
        out = apply(spark, docs, SF)
        assert sorted(out.columns) == sorted(docs.columns), name
    empty = docs.limit(0)
    for name, apply in cp.STAGES:
        assert apply(spark, empty, SF).count() == 0, name
    assert jaccard_join.keep_one(docs).count() < docs.count()


def _odd_docs(spark):
    good = ("The committee met on a quiet morning and agreed to publish its notes for the whole town to read, "
            "because many people had asked what was decided about the old bridge over river number {}. "
            "Nobody objected, and the work began within a week of the vote.")
    rows = [(i, good.format(f"{i} near the {'north south east west'.split()[i % 4]} gate of farm {i * 37}"), None, "s", i) for i in range(60)]
    rows += [(100, None, "en", None, None), (101, "", None, None, 0), (None, good.format("null id"), None, None, None), (None, None, None, None, None),
             (102, " ".join(good.format(f"{i} {i * 7919 % 1013}") for i in range(3000)), "en", "long", None),
             (103, rows[3][1], "en", "copy", 5), (3, rows[3][1], None, "s", 3), (3, rows[3][1], None, "s", 3),
             (104, good.format("mail me at jo@example.org or +1 212 555 0100 today"), None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # columns of names that the stages use inside
    return df.selectExpr("*", "'a' AS digest", "1 AS n", "true AS again", "0.5D AS score", "'q' AS __quality_score", "2 AS gone", "3L AS rows",
                         "'d' AS decoded", "array(1) AS keys", "cast(null AS string) AS item_id")


def test_stages_on_odd_documents(spark):
    docs = _odd_docs(spark)
    before = docs.collect()
    for name, apply in cp.STAGES[:-1]:
        out = apply(spark, docs, SF)
        assert sorted(out.columns) == sorted(docs.columns), name
        rows = out.select(*docs.columns).collect()
        key = lambda r: repr((r.doc_id, r.lang, r.source, r.digest, r.n, r.again, r.score, r.gone, r["rows"], r.decoded, r["keys"], r.item_id))
        assert {key(r) for r in rows} <= {key(r) for r in before}, name
        ids = sorted(r.doc_id for r in rows if r.doc_id is not None)
        if name == "quality":
            assert 100 not in ids and 101 not in ids and ids.count(3) == 3 and 102 in ids and len(rows) == len(before) - 3
        elif name == "near-duplicates":
            assert ids.count(3) == 1 and 103 not in ids and {100, 101, 102} <= set(ids) and sum(r.doc_id is None for r in rows) == 2
        elif name == "decontamination":
            assert len(rows) == len(before)
        else:
            text = {r.doc_id: r.text for r in rows}
            assert "jo@example.org" not in text[104] and "[EMAIL]" in text[104] and text[100] is None and len(rows) == len(before)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    last = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == len(before)
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = sorted((repr(r.doc_id), len(enc.encode_ordinary(r.text or "")), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in before)
    assert sorted((repr(r.doc_id), r.n_tokens, r.decoded_sha256) for r in last) == want
