"""Token-sort similarity as native Spark expressions.

score(a, b) = 200 * LCS(a', b') / (|a'| + |b'|), where x' is x split on
whitespace, tokens sorted and joined by one space (the public definition of a
token-sort ratio built on the Indel distance).  Spark's ``levenshtein`` is a
different distance and is not used.

The LCS of a value against a *configured* label is computed bit-parallel
(Allison-Dix / Hyyro): the label's per-character match masks are built on
the driver from the configuration (a bounded literal), and the value's
characters are folded with ``aggregate`` using 64-bit integer operations.  No
Python runs per row.  Labels longer than 62 characters fall back to a plain
dynamic-programming row carried through ``aggregate``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_BITS = 62


def token_sort(c: Column) -> Column:
    """Split on whitespace, sort tokens, join with one space."""
    stripped = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.array_join(F.array_sort(F.split(stripped, r"\s+")), " ")


def token_sort_py(s: str) -> str:
    return " ".join(sorted(s.split()))


def match_masks(label: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for j, ch in enumerate(label):
        masks[ch] = masks.get(ch, 0) | (1 << j)
    return masks


def masks_literal(label: str) -> Column:
    m = match_masks(label)
    if not m:
        return F.create_map().cast("map<string,bigint>")
    kv = []
    for ch, bits in sorted(m.items()):
        kv += [F.lit(ch), F.lit(bits).cast("bigint")]
    return F.create_map(*kv)


def lcs_bits(a: Column, masks: Column, full: Column, blen: Column) -> Column:
    """LCS length of column ``a`` against a label given by its match masks.

    ``full`` = 2**len(label) - 1; ``blen`` = len(label).  Valid for len <= 62.
    """
    def step(s, ch):
        u = s.bitwiseAND(F.coalesce(F.try_element_at(masks, ch), F.lit(0).cast("bigint")))
        return ((s + u).bitwiseOR(s - u)).bitwiseAND(full)

    final = F.aggregate(F.split(a, ""), full, step)
    return blen - F.bit_count(final)


def lcs_dp(a: Column, b: Column) -> Column:
    """LCS length by the textbook DP; any lengths (used for long labels and tests)."""
    lb = F.length(b)

    def row_step(prev, ch):
        def cell(acc, j):
            hit = F.substring(b, j, 1) == ch
            val = F.when(hit, F.element_at(prev, j) + 1).otherwise(
                F.greatest(F.element_at(acc, j), F.element_at(prev, j + 1)))
            return F.concat(acc, F.array(val))
        return F.aggregate(F.sequence(F.lit(1), lb), F.array(F.lit(0)), cell)

    init = F.array_repeat(F.lit(0), lb + 1)
    dp = F.aggregate(F.split(a, ""), init, row_step)
    return F.when(lb == 0, F.lit(0)).otherwise(F.element_at(dp, lb + 1))


def ratio(lcs: Column, la: Column, lb: Column) -> Column:
    """200 * lcs / (la + lb) as a double; 0 when both are empty."""
    den = la + lb
    return F.when(den == 0, F.lit(0.0)).otherwise(F.lit(200.0) * lcs / den)


def lcs_py(a: str, b: str) -> int:
    """Reference LCS in Python for tests."""
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j in range(1, len(b) + 1):
            cur.append(prev[j - 1] + 1 if ch == b[j - 1] else max(cur[j - 1], prev[j]))
        prev = cur
    return prev[-1]


def token_sort_ratio_py(a: str, b: str) -> float:
    a2, b2 = token_sort_py(a), token_sort_py(b)
    den = len(a2) + len(b2)
    return 0.0 if den == 0 else 200.0 * lcs_py(a2, b2) / den
