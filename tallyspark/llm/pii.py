"""Operator 7: personal data by anchor expansion.

One Aho-Corasick pass per text finds the anchors: at-signs, plus signs, digits,
scheme marks and identifier cues.  A deterministic parser then expands from each
anchor to the boundaries of an address or account and validates it; nothing else
of the text is looked at.  The parsers of the four base kinds give exactly the
leftmost non-overlapping matches of their patterns.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, texts

# Kinds in the order of a tie, base kinds first.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "url", "secret", "account")
KINDS = BASE + ADDED

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s]*)?")
_VALUE = re.compile(r"""\s{0,3}[:=]\s{0,3}(["']?)([^\s"']{8,})\1""")
_NUMBER = re.compile(r"(?:\s{1,2}(?:number|no\.?|nr\.?))?\s{0,2}[:#=]?\s{0,2}([0-9](?:[ -]?[0-9]){5,16})(?![0-9])")
_SSN = re.compile(r"[^0-9\n]{0,12}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_IBAN = re.compile(r"[^A-Za-z0-9\n]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")

# Cue -> parser, found in lower case, with a first capital, and in capitals.
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "password": "secret", "passwd": "secret",
        "token": "secret", "api_key": "secret", "apikey": "secret", "secret": "secret",
        "account": "account", "acct": "account", "://": "url"}


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("email", 1))
    a.add_word("+", ("phone", 1))
    for cue, parser in CUES.items():
        for form in {cue, cue.capitalize(), cue.upper()}:
            a.add_word(form, (parser, len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    text = text.replace(" ", "")
    moved = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


class Finder:
    """``spans`` gives every (kind, start, end) of a text, end exclusive, by start and kind."""

    def __init__(self):
        self.automaton = _automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        out: list[tuple[str, int, int]] = []
        done = dict.fromkeys(KINDS, 0)  # no later span of a kind begins before this
        for last, (kind, size) in self.automaton.iter(text):
            at = last - size + 1
            if kind == "digit":
                if at >= done["ip"]:
                    m = _IP.match(text, at)
                    done["ip"] = (m or _DIGITS.match(text, at)).end()  # without a match here, none begins later in these digits
                    if m and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                        out.append(("ip", *m.span()))
                if at >= done["card"] and (m := _CARD.match(text, at)):
                    done["card"] = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", *m.span()))
            elif kind == "email":
                lo = at
                while lo > done["email"] and text[lo - 1] in _LOCAL:
                    lo -= 1
                if lo < at and (m := _DOMAIN.match(text, at + 1)):
                    done["email"] = m.end()
                    out.append(("email", lo, m.end()))
            elif kind == "phone":
                if at >= done["phone"] and (m := _PHONE.match(text, at)):
                    done["phone"] = m.end()
                    if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                        out.append(("phone", *m.span()))
            elif span := getattr(self, f"_{kind}")(text, at, last + 1):
                if span[0] >= done[kind]:
                    done[kind] = span[1]
                    out.append((kind, *span))
        out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
        return out

    # Parsers of the added kinds: (start, end) or None, from a cue at text[at:end].
    @staticmethod
    def _word_start(text: str, at: int) -> bool:
        return at == 0 or not text[at - 1].isalnum()

    def _iban(self, text, at, end):
        m = self._word_start(text, at) and _IBAN.match(text, end)
        while m:
            if iban_ok(m.group(1)):
                return m.span(1)
            cut = m.end(1) - 1  # words after the number may have been taken along
            m = _IBAN.match(text, end, cut) if cut > end else None
        return None

    def _ssn(self, text, at, end):
        m = self._word_start(text, at) and _SSN.match(text, end)
        return m.span(1) if m and m.group(1)[:3] not in ("000", "666") and m.group(1)[0] != "9" else None

    def _secret(self, text, at, end):
        m = self._word_start(text, at) and _VALUE.match(text, end)
        return m.span(2) if m and any(map(str.isdigit, m.group(2))) else None

    def _account(self, text, at, end):
        m = self._word_start(text, at) and _NUMBER.match(text, end)
        return m.span(1) if m else None

    def _url(self, text, at, end):
        lo = at
        while lo > 0 and text[lo - 1].isascii() and (text[lo - 1].isalnum() or text[lo - 1] in "+.-"):
            lo -= 1
        m = _LOGIN.match(text, end)  # an address that carries a login
        return (lo, m.end()) if m and lo < at else None


_FINDER: list[Finder] = []


def finder() -> Finder:
    if not _FINDER:
        _FINDER.append(Finder())
    return _FINDER[0]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_spans, spans) of every row.

    Spans are ``kind:start:end`` in code points.  A null or empty text has none;
    a null id is kept; repeated rows each give their row; other columns are left out.
    """
    kind = df.schema[id_col].dataType.simpleString()
    names = [id_col, *(f"n_{k}" for k in BASE), "base_spans", "spans"]

    def make():
        f = finder()

        def step(batch):
            found = [f.spans(t) for t in texts(batch.column(1))]
            base = [[s for s in x if s[0] in BASE] for x in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                *(pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in BASE),
                pa.array(map(_joined, base), pa.string()), pa.array(map(_joined, found), pa.string())], names)
        return step

    return map_rows(df.select(id_col, text_col),
                    f"`{id_col}` {kind}, " + ", ".join(f"n_{k} bigint" for k in BASE) + ", base_spans string, spans string",
                    make)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first stands for all."""
    out, at = [], 0
    for k, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``df``, every row and column, with personal data masked in the text (and its length renewed).

    A null or empty text stays as it is; repeated rows are masked alike; a null id
    and columns of any name pass through; an empty table stays empty; a text of any length is masked whole.
    """
    names = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def make():
        f = finder()

        def step(batch):
            at, cols = names.index(text_col), list(batch.columns)
            new = [t if not t else mask(t, f.spans(t)) for t in cols[at].to_pylist()]
            cols[at] = pa.array(new, pa.string())
            if n_chars_col in names:
                i = names.index(n_chars_col)
                cols[i] = pa.array([None if t is None else len(t) for t in new], cols[i].type)
            yield pa.RecordBatch.from_arrays(cols, names)
        return step

    return map_rows(df, schema, make)


def digest(df: DataFrame) -> DataFrame:
    """doc_id, the four base counts, base_sha256 and all spans."""
    return find(df).select("doc_id", *(f"n_{k}" for k in BASE), F.sha2("base_spans", 256).alias("base_sha256"), "spans")
