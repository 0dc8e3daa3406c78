import hashlib
import random
import re

import pytest

from tallyspark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[ -]", "", m.group())
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize("letters", ["ab1.@ -", "0123456789 -+().", "12.5 @a-", "049 -", "٣1.2+ ("])
def test_base_spans_are_the_patterns_matches(letters):
    rng, f = random.Random(3), pii.Finder()
    for _ in range(4000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 70)))
        assert [s for s in f.spans(t) if s[0] in pii.BASE] == base(t), t


@pytest.mark.parametrize("text, kind, found", [
    ("IBAN: GB82 WEST 1234 5698 7654 32 and", "iban", "GB82 WEST 1234 5698 7654 32"), ("my ssn is 123-45-6789.", "ssn", "123-45-6789"),
    ("ssn 666-45-6789", "ssn", None), ("https://bob:pw1@host.example/x y", "url", "https://bob:pw1@host.example/x"),
    ("https://host.example/x", "url", None), ("password=b7db7aa4a5fcc78305 x", "secret", "b7db7aa4a5fcc78305"),
    ("password: forgotten", "secret", None), ("account no: 12345678 x", "account", "12345678"), ("on account of 12", "account", None)])
def test_added_kinds(text, kind, found):
    spans = [text[a:b] for k, a, b in pii.Finder().spans(text) if k == kind]
    assert spans == ([found] if found else [])


def test_long_runs_are_linear():
    f = pii.Finder()
    assert f.spans("1" * 200_000) == [] and f.spans("a" * 200_000 + "@") == [] and f.spans("1." * 100_000)
    assert f.spans("@" * 50_000) == []


def test_rows_and_masking(make_docs):
    rows = [(1, "mail a.b@c.example now"), (2, None), (3, ""), (None, "x@y.zz"), (1, "mail a.b@c.example now"), (4, "clean words stay")]
    got = pii.digest(make_docs(rows)).collect()
    assert len(got) == 6
    one = [r for r in got if r.doc_id == 1]
    assert one[0] == one[1] and one[0].n_email == 1 and one[0].spans == "email:5:18"
    assert one[0].base_sha256 == hashlib.sha256(b"email:5:18").hexdigest()
    docs = make_docs(rows)
    masked = pii.redact(docs)
    assert masked.columns == docs.columns
    texts = {(r.doc_id, r.text, r.n_chars) for r in masked.collect()}
    assert texts == {(1, "mail [EMAIL] now", 16), (2, None, None), (3, "", 0), (None, "[EMAIL]", 7), (4, "clean words stay", 16)}
    assert pii.redact(make_docs([])).count() == 0
