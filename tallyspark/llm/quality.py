"""Operator 10: quality classifier from weak labels.

Twelve heuristic labellers vote good (1), bad (0) or abstain on every document.
The votes of all documents are counted by pattern (at most 3^12 patterns), and
expectation-maximisation on the counts estimates the prior and how each labeller
votes on good and on bad documents.  The posterior of a document's pattern is
its label; a linear scorer on hashed features is trained on a bounded sample of
distinct texts with these labels and then scores every document.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, sized, stage, texts

#: Distinct texts that the scorer is trained on, at most.
SAMPLE = 8000
BUCKETS = 1 << 13

_SYMBOLS = b"#$%&*<>{}\\^~=_@"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_RUN = re.compile(rb"[#$%&*!?=~^_|]{2,}")


def statistics(text: str) -> tuple[float, ...]:
    """Shares that labellers and scorer look at; all 0 for a text without words."""
    data = text.encode()
    words = data.split()
    n, size = len(words), max(1, len(data))
    if not n:
        return (0.0,) * 13
    share = lambda drop: (len(data) - len(data.translate(None, drop))) / size
    triples = len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 1.0
    echo = sum(map(bytes.__eq__, words, words[1:])) / n
    return (float(n), share(_SYMBOLS), share(_UPPER), data.count(b" | ") / n, len(_RUN.findall(data)) / n,
            triples, echo, size / n, share(_DIGITS), sum(not w.translate(None, _MARKS) for w in words) / n, share(_MARKS),
            len(set(words)) / n, len(zlib.compress(data, 1)) / size)


def votes(s: tuple[float, ...]) -> str:
    """One character for each labeller: 1 good, 0 bad, - abstain."""
    size = s[0] * s[7]
    n, symbols, upper, bars, runs, triples, echo, length, digits, lone, marks, distinct, packed = s
    if not n:
        return "0" * 12
    pick = lambda bad, good: "0" if bad else "1" if good else "-"
    return (pick(symbols > .05, symbols < .02) + pick(upper > .3, upper < .12 or n < 5) + pick(bars > .05, bars < .005)
            + pick(runs > .05, runs < .01) + (pick(triples < .5, triples > .75) if n >= 20 else "-")
            + pick(echo > .15, echo < .05) + pick(length < 2.5 or length > 20, 3.5 < length < 14) + (pick(digits > .25, digits < .1) if n >= 30 else "-")
            + pick(lone > .08, lone < .02) + (pick(marks > .09, marks < .06) if n >= 30 else "-")
            + (pick(distinct < .3, distinct > .36) if 15 <= n < 2000 else "-") + (pick(packed < .25, packed > .33) if size > 100 else "-"))


def label_model(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """Posterior of "good" for each pattern, by expectation-maximisation.

    Starts from whether two labellers or more vote bad.  A labeller has a share
    of bad votes among those it casts on good and on bad documents, smoothed by one vote.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    count = np.array([patterns[p] for p in names], float)
    x = np.array([["01-".index(c) for c in p] for p in names])
    cast = (x[:, :, None] == np.arange(2)).astype(float)  # a labeller that abstains says nothing
    q = np.where((x == 0).sum(1) >= 2, .1, .9)
    for _ in range(rounds):
        prior = (count @ q + 1) / (count.sum() + 2)
        good = np.einsum("p,pkv->kv", count * q, cast) + 1
        bad = np.einsum("p,pkv->kv", count * (1 - q), cast) + 1
        good, bad = good / good.sum(1, keepdims=True), bad / bad.sum(1, keepdims=True)
        odds = np.log(prior / (1 - prior)) + np.einsum("pkv,kv->p", cast, np.log(good / bad))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return dict(zip(names, q.tolist()))


# -------------------------------------------------------------------- scorer
class Features:
    """text -> hashed features: bins of the shares, and the shapes of words and of pairs of neighbours."""

    def __init__(self):
        self.shapes: dict[bytes, bytes] = {}

    @staticmethod
    def _bucket(name: bytes) -> int:
        return xxhash.xxh3_64_intdigest(name) % BUCKETS

    def _shape(self, word: bytes) -> bytes:
        s = self.shapes.get(word)
        if s is None:
            s = re.sub(rb"[a-z\x80-\xff]+", b"a", re.sub(rb"[A-Z]{2,}", b"AA", re.sub(rb"[0-9]+", b"0", word)))[:12]
            if len(self.shapes) >= 1 << 17:
                self.shapes.clear()
            self.shapes[word] = s
        return s

    def __call__(self, text: str, s: tuple[float, ...]) -> dict[int, float]:
        words = text.encode().split()
        n = max(1, len(words))
        out: dict[int, float] = {}
        for shape, k in Counter(map(self._shape, words)).items():
            b = self._bucket(b"w" + shape)
            out[b] = out.get(b, 0) + (k / n) ** .5
        for i, v in enumerate(s):
            level = int(np.log2(v + 1)) if i == 0 else min(19, int(v * 20)) if i not in (7,) else min(19, int(v))
            b = self._bucket(b"s%d:%d" % (i, level))
            out[b] = out.get(b, 0) + 1.0
        return out


def train(rows: list[tuple[list[int], list[float], float]], rounds: int = 300, l2: float = 1e-4) -> np.ndarray:
    """Weights (the last is the constant) of a logistic scorer on soft labels, by accelerated gradient steps."""
    w = np.zeros(BUCKETS + 1)
    if not rows:
        return w
    at = np.repeat(np.arange(len(rows)), [len(r[0]) + 1 for r in rows])
    col = np.concatenate([[*r[0], BUCKETS] for r in rows]).astype(np.int64)
    val = np.concatenate([[*r[1], 1.0] for r in rows])
    y = np.array([r[2] for r in rows])
    rate = 4 / max(np.bincount(at, val * val).max(), 1e-9)
    v, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, val * v[col], len(rows)), -50, 50)))
        grad = np.bincount(col, val * (p - y)[at], len(w)) / len(rows)
        grad[:-1] += l2 * v[:-1]
        new, t2 = v - rate * grad, (1 + (1 + 4 * t * t) ** .5) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


def fit(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> tuple[dict[str, float], np.ndarray]:
    """The label model of all rows and the scorer's weights; both have a fixed size."""
    rows = df.select(F.col(text_col).alias("text"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))

    def make():
        def step(batch):
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([votes(statistics(t)) for t in texts(batch.column(0))])],
                                             ["h", "pattern"])
        return step

    voted = stage(map_rows(rows, "h bigint, pattern string", make), "quality-votes")
    posterior = label_model(dict(voted.groupBy("pattern").count().collect()))  # at most 3^12 rows
    chosen = stage(voted.select("h").distinct().orderBy("h").limit(sample), "quality-sample")

    def features():
        f = Features()

        def step(batch):
            out = []
            for t, h in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                s = statistics(t)
                x = f(t, s)
                out.append((h, votes(s), list(x), list(x.values())))
            types = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["h", "pattern", "cols", "vals"])
        return step

    found = map_rows(rows.join(sized(chosen, 16), "h").select("text", "h"),
                     "h bigint, pattern string, cols array<int>, vals array<double>", features)
    found = found.groupBy("h").agg(F.min(F.struct("pattern", "cols", "vals")).alias("r")).orderBy("h").collect()  # at most ``sample`` rows
    return posterior, train([(r.r.cols, r.r.vals, posterior[r.r.pattern]) for r in found])


class Judge:
    """text -> (label model's posterior, scorer's probability of "good")."""

    def __init__(self, model: tuple[dict[str, float], np.ndarray]):
        self.posterior, self.weights = model
        self.features = Features()

    def __call__(self, text: str) -> tuple[float, float]:
        s = statistics(text)
        if not s[0]:
            return self.posterior.get(votes(s), 0.0), 0.0
        z = self.weights[-1] + sum(self.weights[c] * v for c, v in self.features(text, s).items())
        return self.posterior.get(votes(s), 0.0), float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def score(df: DataFrame, model: tuple[dict[str, float], np.ndarray], text_col: str = "text",
          label: str = "weak_label", out: str = "quality_score") -> DataFrame:
    """``df`` with the label model's posterior and the scorer's probability of "good" (both 0 to 1).

    Every row gets them; a null text counts as an empty one, which scores 0.
    The new columns replace columns of the same names.
    """
    df = df.select(*(c for c in df.columns if c not in (label, out)))
    names = df.columns
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)

    def make():
        judge = Judge(model)

        def step(batch):
            both = [judge(t) for t in texts(batch.column(names.index(text_col)))]
            weak, scores = [a for a, _ in both], [b for _, b in both]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weak, pa.float64()), pa.array(scores, pa.float64())],
                                             [*names, label, out])
        return step

    return map_rows(df, f"{schema}`{label}` double, `{out}` double", make)


def classify(df: DataFrame, sample: int = SAMPLE, threshold: float = .5) -> DataFrame:
    """doc_id, weak_label, quality_score, keep: fitted on, and applied to, all rows of ``df``.

    A null or empty text scores 0 and is not kept; repeated rows and null ids give a row each; an empty table
    gives no rows; texts of any length are looked at whole; other columns are left out.
    """
    rows = df.select("doc_id", "text")
    return (score(rows, fit(rows, sample=sample)).select("doc_id", "weak_label", "quality_score")
            .withColumn("keep", F.col("quality_score") >= threshold))


def keep_good(df: DataFrame, sample: int = SAMPLE, threshold: float = .5) -> DataFrame:
    """The rows of ``df``, every column, that score ``threshold`` or more.

    Null and empty texts go.  Rows that fail are left out where they are scored, so
    only kept rows travel back; repeated rows are judged alike; columns of any
    name come through; an empty table stays empty.
    """
    names = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    model = fit(df, sample=sample)

    def make():
        judge = Judge(model)

        def step(batch):
            good = [judge(t)[1] >= threshold for t in texts(batch.column(names.index("text")))]
            yield batch.filter(pa.array(good, pa.bool_()))
        return step

    return map_rows(df, schema, make)
