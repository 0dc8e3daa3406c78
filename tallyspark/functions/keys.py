"""Deterministic row keys.

K1: sha256 over ``date|particulars|dr|cr`` (null -> "", stripped and
lower-cased), first 16 hex characters.  Numbers are rendered the way a Python
float prints a 2-decimal amount (``150.0``, ``150.25``), dates as
``yyyy-MM-dd HH:mm:ss``, so keys are stable across engines and reruns.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import py_strip


def amount_key_text(c: Column) -> Column:
    """Decimal -> '150.0' / '150.25' (two places, trailing zero of the cents dropped)."""
    text = c.cast("decimal(18,2)").cast("string")
    return F.substring(text, F.lit(1), F.length(text) - text.endswith("0").cast("int"))


def _part(c: Column, dtype: str) -> Column:
    if dtype == "day":          # a date without time of day: midnight, whatever the session's time zone
        txt = F.concat(c.cast("string"), F.lit(" 00:00:00"))
    elif dtype == "date":
        txt = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif dtype.startswith("decimal"):
        txt = amount_key_text(c)
    else:
        txt = F.lower(py_strip(c.cast("string")))
    return F.coalesce(txt, F.lit(""))


def row_digest(parts: list[tuple[Column, str]]) -> Column:
    return F.sha2(F.concat_ws("|", *[_part(c, t) for c, t in parts]), 256)


#: Column of month tables and the master with the whole digest behind the key, as 32 bytes.
DIGEST = "row_digest"


def digest_bytes(parts: list[tuple[Column, str]]) -> Column:
    return F.unhex(row_digest(parts))


def key_of(digest: Column, width: int = 16) -> Column:
    """The row key (first ``width`` hexadecimal characters) of a digest in bytes."""
    return F.lower(F.hex(F.substring(digest, 1, width // 2)))


def row_key(parts: list[tuple[Column, str]], width: int = 16) -> Column:
    return F.substring(row_digest(parts), 1, width)


def txn_key(txn_id: Column, fallback: Column, min_len: int, stop_words: tuple[str, ...]) -> Column:
    """Transaction id when it is long enough and not a stop word, else the hash."""
    tid = F.upper(py_strip(txn_id))
    ok = (F.length(tid) >= min_len) & ~tid.isin(*[w.upper() for w in stop_words])
    return F.when(F.coalesce(ok, F.lit(False)), tid).otherwise(fallback)
