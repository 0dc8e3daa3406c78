"""The registered queries on a given table, against reference libraries, plain Python or their SQL."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return E.queries()[name](spark, SF).collect()


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("name", ["op1_embedding_dedup", "op3_decontamination", "op6_substring_dedup", "op9_jaccard_join"])
def test_like_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(E.oracle_sql()[name])
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())


def test_bpe_like_tiktoken(spark):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = {}
    for r in table("documents"):
        ids = enc.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha((r["text"] or "").encode()))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op2_bpe_round_trip")} == want


def test_token_store_like_the_tokenizers_library(spark):
    import tokenizers
    enc = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = {}, 0
    for r in sorted(table("documents"), key=lambda r: r["doc_id"]):
        ids = [*enc.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want[r["doc_id"]] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in run(spark, "op5_token_store")} == want


def test_warc_like_the_pages(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table("pages")}
    top = defaultdict(int)
    for i, data in pages.items():
        top[data] = max(top[data], i)
    want = {i: (len(d), hashlib.sha1(d).hexdigest(), *(("revisit", top[d]) if len(d) >= 1000 and top[d] != i else ("response", None)))
            for i, d in pages.items()}
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in run(spark, "op4_warc")} == want


def _luhn(digits):
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def _base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and _luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15)}
    kinds = list(rules)
    found = [(m.start(), kinds.index(k), k, m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m.group())]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_pii_like_the_patterns(spark):
    want = {}
    for r in table("documents"):
        found = _base(r["text"] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        want[r["doc_id"]] = (*(sum(k == x for k, *_ in found) for x in ("email", "ip", "card", "phone")), sha(joined.encode()))
    got = run(spark, "op7_pii")
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got} == want
    assert sum(sum(v[:4]) for v in want.values()) > 0


