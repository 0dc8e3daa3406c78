"""Operator 13: maximal periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q and at least max(6, 4 q) words
that cannot grow.  Periods below ``DIRECT`` are read off by comparing the words with
themselves q further on.  For periods q in [p, 2p), p a power of two, a run holds
windows of p consecutive 2p-word grams together with the same windows q later.
Their minima are q apart, and as 2p >= q the least gram recurs inside the run at
multiples of q alone, so the two are neighbours among the equal minima.  Such
pairs are the seeds, extended word by word in both directions.  Grams are compared
by exact numbers (pairs of numbers of half their length), never by a digest.

Documents of a batch are laid end to end with separators that equal no word, so
each step is one array operation over some megabytes of text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_rows, mix64

#: Periods below this are found by direct lag scans (a power of two).
DIRECT = 16
#: Bytes of text that are worked on together (one document at least).
GROUP_BYTES = 2 << 20

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def words_of(text: bytes | None) -> list[bytes]:
    """Words between the ASCII spaces 0x20 and 0x09 to 0x0D, which are what ``split`` takes for spaces in bytes."""
    return text.split() if text else []


def least_length(q: int) -> int:
    return max(6, 4 * q)


def _stretches(at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the stretches of at least ``least`` consecutive numbers in ``at``."""
    if len(at) < least:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.flatnonzero(np.diff(at) != 1)
    first, last = at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + 1
    long = last - first >= least
    return first[long], last[long]


def _direct(w: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    """Lag scans: stretches where a word equals the one q further on, for each short q."""
    for q in range(1, min(DIRECT, len(w))):
        for s, e in zip(*_stretches(np.flatnonzero(w[q:] == w[:-q]), least_length(q) - q)):
            found.setdefault((int(s), int(e) + q), q)


def _selected(order: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least of some window of ``width`` (a power of two) places, ties included."""
    n, step = len(order), 1
    low = order
    while step < width:                                     # low[i]: least of the places i .. i + 2 step - 1
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        step *= 2
    if not len(low):
        return np.empty(0, np.int64)
    high = np.concatenate([np.zeros(width - 1, order.dtype), low, np.zeros(width - 1, order.dtype)])
    step = 1
    while step < width:                                     # greatest of the minima of all windows that hold place i
        high = np.maximum(high[:-step], high[step:])
        step *= 2
    return np.flatnonzero(high[:n] >= order)


def _mismatch(w: np.ndarray, at: int, q: int, way: int) -> int:
    """First place from ``at`` in direction ``way`` where the word differs from the one q further on."""
    step = 64
    while True:
        lo, hi = (at, min(at + step, len(w) - q)) if way > 0 else (max(at - step + 1, 0), at + 1)
        if hi <= lo:
            return at
        differs = np.flatnonzero(w[lo:hi] != w[lo + q:hi + q])
        if len(differs):
            return int(lo + differs[0 if way > 0 else -1])
        at, step = (hi, step * 2) if way > 0 else (lo - 1, step * 2)


def _scale(w: np.ndarray, grams: np.ndarray, places: np.ndarray, p: int, found: dict[tuple[int, int], int]) -> None:
    """Runs with periods in [p, 2p); ``grams`` numbers the 2p-word grams that begin at ``places``."""
    at = _selected(mix64(grams.astype(np.uint64) + np.uint64(1)), p)
    if len(at) < 2:
        return
    by = np.argsort(grams[at], kind="stable")
    equal, at = grams[at][by], at[by]
    gap = np.diff(at)
    seeds = np.flatnonzero((equal[1:] == equal[:-1]) & (gap >= p) & (gap < 2 * p))
    if not len(seeds):
        return
    seeds = seeds[np.lexsort((at[seeds], gap[seeds]))]
    period, end = 0, 0
    for m, q in zip(places[at[seeds]].tolist(), gap[seeds].tolist()):
        if q == period and m < end:
            continue                                        # inside the stretch that was last extended
        period, end = q, _mismatch(w, m, q, 1)
        start = _mismatch(w, m, q, -1) + 1
        if end + q - start >= least_length(q):
            key = (start, end + q)
            found[key] = min(q, found.get(key, q))


def find(docs: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document, by start, then period; words are given as numbers >= 0.

    A stretch that repeats with two lengths q and q' | q is reported once, with its
    smallest period: it then begins and ends at the same words for both.
    """
    sizes = np.array([len(d) for d in docs], np.int64)
    if not len(sizes):
        return []
    w = np.concatenate([part for i, d in enumerate(docs) for part in (d, [-1 - i])]).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    found: dict[tuple[int, int], int] = {}
    _direct(w, found)
    longest, p = int(sizes.max()), DIRECT
    places, grams, length = np.arange(len(w)), w - w.min(), 1
    while longest >= least_length(p):
        inside = np.repeat(sizes >= least_length(p), sizes + 1)[places]      # whole documents stay or go
        places, grams = places[inside], grams[inside]
        while length < 2 * p:
            last = grams.max() + 1
            pair = np.append(grams[length:], np.full(min(length, len(grams)), last))
            grams, length = pd.factorize(grams * (last + 1) + pair)[0], 2 * length
        _scale(w, grams, places, p, found)
        p *= 2
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    for (s, e), q in sorted(found.items(), key=lambda x: (x[0][0], x[1])):
        i = int(np.searchsorted(starts, s, "right")) - 1
        out[i].append((s - int(starts[i]), e - s, q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        edge[s + q] += 1
        edge[s + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def _groups(sizes: list[int]) -> Iterator[slice]:
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > GROUP_BYTES:
            yield slice(lo, i)
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield slice(lo, len(sizes))


Edit = Callable[[int | None, int], np.ndarray | None]


def periodic_runs(docs: DataFrame, edit: Edit | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period by start, then period), collapsed binary.

    Words lie between ASCII spaces and are compared byte by byte; ``collapsed`` is the UTF-8 text
    without the words that some run holds after its first period, joined by one
    space.  A null or empty text has no words and no runs.  Repeated ids give one row
    each; a null id stays null; other columns are ignored.  An empty table gives no
    rows.  Any text length is taken whole: a task holds one document, or some
    megabytes of them, at a time.  ``edit(doc_id, n_words)`` may give the numbers of the words to read
    instead of the document's own sequence.
    """
    schema = f"doc_id bigint, n_words bigint, runs {RUN}, collapsed binary"
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    df = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = [n or 0 for n in pc.binary_length(column).to_pylist()]
            for some in _groups(sizes):
                words = [words_of(t) for t in column[some].cast(pa.binary()).to_pylist()]
                if edit is not None:
                    for i, (d, ws) in enumerate(zip(ids[some], words)):
                        order = edit(d, len(ws))
                        if order is not None:
                            words[i] = [ws[j] for j in order.tolist()]
                flat = pa.array([x for ws in words for x in ws], pa.binary()).dictionary_encode().indices.to_numpy()
                runs = find(np.split(flat.astype(np.int64), np.cumsum([len(ws) for ws in words])[:-1]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[some], pa.int64()), pa.array([len(ws) for ws in words], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], run_type),
                    pa.array([collapse(ws, r) for ws, r in zip(words, runs)], pa.binary())], [f.split()[0] for f in schema.split(", ")])
        return step

    return map_rows(df, schema, make)


def greatest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties to the smallest start, then period; null without runs."""
    def before(a: Column, b: Column) -> Column:
        by = [(b["length"] * a["period"], a["length"] * b["period"]), (a["start"], b["start"]), (a["period"], b["period"])]
        out = F.lit(0)
        for x, y in reversed(by):
            out = F.when(x < y, -1).when(x > y, 1).otherwise(out)
        return out
    return F.get(F.array_sort(runs, before), F.lit(0))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The word numbers of a document of ``n`` words in which the query plants a period, else None.

    A null id plants nothing.
    """
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.r_[np.arange(a), a + np.arange(n - a) % p]


def digest(docs: DataFrame, edit: Edit | None = planted) -> DataFrame:
    """Counts, greatest run and digests per document, from the rows of ``periodic_runs``."""
    found = periodic_runs(docs, edit)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.select("doc_id", "runs", "collapsed", greatest(F.col("runs")).alias("best"))
                 .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                         F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))
