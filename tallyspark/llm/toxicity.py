"""Operator 8: toxicity with noisy-channel deobfuscation.

A token that does not look like a plain word (digits or symbols among letters,
letters repeated three times or more, letters written apart) becomes a lattice:
each character may stand for itself, for the letters it is used for, or for
nothing (separators, repetitions), at a channel cost.  Viterbi decoding finds
the cheapest path under a character trigram language model, whose counts are
gathered from all documents.  The restored words are then scored.

The scorer is learnt from counts over all labelled training documents: for each
hashed feature of a word (the word, its beginnings of 3 to 7 letters) the
documents of either label that hold it.  A word weighs as its most telling
feature.  A logistic curve on the summed weights of a document's distinct words,
fitted on counts per bin, gives the score.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .chunks import Generations
from .common import count_blocks, map_rows, sized, stage, summed_counts, texts

# ------------------------------------------------------------ language model
#: Letters of the model: 0 stands for anything else, then a-z, then the small letters of Latin-1.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_INDEX = {c: i + 1 for i, c in enumerate(_LETTERS)}
_OTHER = 63
LM_BLOCKS = 64


def _table() -> np.ndarray:
    t = np.zeros(0x251, np.uint32)
    for c in range(0x250):
        ch = chr(c)
        if ch.isalpha():
            t[c] = _INDEX.get(ch.lower(), _OTHER)
    t[0x250] = _OTHER
    return t


def trigram_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all whole texts: 64^3 numbers, whatever the input."""
    def make():
        letters, counts = _table(), np.zeros(1 << 18, np.int64)

        def step(batch):
            data = "\n".join(["", *texts(batch.column(0)), ""]).encode("utf-32-le")
            x = letters[np.minimum(np.frombuffer(data, "<u4"), 0x250)]
            x = (x[:-2] << 12) | (x[1:-1] << 6) | x[2:]
            counts[:] += np.bincount(x, minlength=len(counts))
            return ()

        step.close = lambda: [pa.RecordBatch.from_arrays([*count_blocks(counts, LM_BLOCKS)], ["block", "counts"])]
        return step

    got = summed_counts(map_rows(df.select(text_col), "block int, counts binary", make), LM_BLOCKS)
    return got if len(got) else np.zeros(1 << 18, np.int64)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Costs (negative logarithms) of a letter after two others, smoothed by the letter after one and alone."""
    c = counts.reshape(64, 64, 64).astype(float)
    one = c.sum((0, 1)) + 1
    one /= one.sum()
    two = c.sum(0)
    two = (two + 20 * one) / (two.sum(1, keepdims=True) + 20)
    return -np.log((c + 20 * two) / (c.sum(2, keepdims=True) + 20)).astype(np.float32)


# ------------------------------------------------------------------- channel
# The letters that a character is used for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l"}
#: Costs of reading a character as another letter; of skipping a repeated character, a separator, a
#: character that may stand for a letter (a letter read costs two to three by the language model).
SWAP, REPEAT, SKIP, SKIP_LEET = 0.7, 0.2, 1.2, 8.0
_TRIPLE = re.compile(r"(.)\1\1")
_APART = re.compile(r"(?<!\S)\S(?:[ ]\S){3,}(?!\S)")
#: What every such run holds, looked for first.
_APART_HINT = re.compile(r" \S \S \S")


class Restorer:
    """Token -> the word it most likely hides."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()

    @staticmethod
    def plain(token: str) -> bool:
        """A word that needs no decoding once the punctuation around it is gone."""
        return token.isalpha() and not _TRIPLE.search(token)

    def __call__(self, token: str) -> str:
        word = token.strip(".,;:?\"'()[]{}").rstrip("!").lower()
        if self.plain(word) or not any(map(str.isalpha, word)):
            return word
        return self.viterbi(word)

    def viterbi(self, word: str) -> str:
        """The cheapest reading; a state is the last two letters read."""
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for ch in word:
            options = [(c, SWAP) for c in LEET.get(ch, "")]
            skip = None
            if ch.isalpha():
                options.append((ch, 0.0))
                if ch == before:
                    skip = REPEAT
            else:
                skip = REPEAT if ch == before else SKIP_LEET if ch in LEET else SKIP
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, back) in paths.items():
                if skip is not None:
                    old = new.get((a, b))
                    if old is None or cost + skip < old[0]:
                        new[a, b] = (cost + skip, back)
                for c, price in options:
                    i = _INDEX.get(c, _OTHER)
                    total = cost + price + self.costs[a][b][i]
                    old = new.get((b, i))
                    if old is None or total < old[0]:
                        new[b, i] = (total, (c, back))
            paths, before = new, ch
        cost, back = min(((cost + self.costs[a][b][0], back) for (a, b), (cost, back) in paths.items()), key=lambda p: p[0])
        out = []
        while back is not None:
            out.append(back[0])
            back = back[1]
        return "".join(reversed(out))

    def words(self, text: str, memory: dict[str, str]) -> set[str]:
        """The distinct restored words of a text, letters written apart put together."""
        out = set(map(memory.__getitem__, set(text.split())))
        for m in _APART.finditer(text) if _APART_HINT.search(text) else ():
            run = m.group().replace(" ", "")
            if any(map(str.isalpha, run)):
                # a neighbouring word of one letter may belong to the run: words begin anywhere in it
                whole = run.lower() if self.plain(run) else self.viterbi(run.lower())
                out.update(whole[i:i + 24] for i in range(len(whole)))
        out.discard("")
        return out


# -------------------------------------------------------------------- scorer
#: A feature has a bucket in each of ``ROWS`` tables of 2^BITS counts; a bucket that it shares by
#: accident with a telling feature does not count unless all of its buckets do.
ROWS, BITS, BLOCKS = 3, 19, 192
#: Likelihood ratio beyond chance (about 1 in 2e7 features); least log odds of a telling feature.
BEYOND, ODDS = 30.0, 5.0
#: The same for a feature that is likely but not telling; its log odds are shrunk by PRIOR documents
#: of neutral rate and by LESS.
LIKELY, LIKELY_ODDS, PRIOR, LESS = 15.0, 3.0, 2.0, 1.0


def features(word: str) -> list[int]:
    """Hashes of a word, and of its beginnings of 3 to 7 letters."""
    names = ["=" + word, *("^" + word[:k] for k in range(min(7, len(word)), 2, -1))]
    return [xxhash.xxh3_64_intdigest(x) for x in names]


def _buckets(hashes: np.ndarray) -> np.ndarray:
    """The bucket of each hash in every table, the tables laid end to end."""
    mask = np.uint64((1 << BITS) - 1)
    return np.stack([((hashes >> np.uint64(BITS * r)) & mask).astype(np.int64) + (r << BITS) for r in range(ROWS)])


def feature_counts(df: DataFrame, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents of label 0 and of label 1 per bucket, and in all, of all rows of (text, toxic); of fixed size."""
    size = ROWS << BITS

    def make():
        restore = Restorer(costs)
        memory = Generations(restore, 1 << 17)
        cached = Generations(lambda w: np.array(features(w), np.uint64).tobytes(), 1 << 17)
        counts, last = np.zeros(2 * size, np.int64), np.zeros(size, np.int32)
        total = np.zeros(2, np.int64)

        def step(batch):
            for t, label in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                total[label] += 1
                words = restore.words(t, memory)
                if words:
                    held = _buckets(np.frombuffer(b"".join([cached[w] for w in words]), np.uint64)).ravel()
                    place = np.arange(len(held), dtype=np.int32)
                    last[held] = place                       # of the places of a bucket one stays:
                    counts[held[last[held] == place] + label * size] += 1  # a document counts once for a bucket
            return ()

        def close():
            block, data = count_blocks(counts, 2 * BLOCKS, "<u4")
            yield pa.RecordBatch.from_arrays([block, data], ["block", "counts"])
            yield pa.RecordBatch.from_arrays([pa.array([2 * BLOCKS], pa.int32()), pa.array([total.astype("<u4").tobytes()])],
                                             ["block", "counts"])
        step.close = close
        return step

    parts = stage(map_rows(df.select("text", "toxic"), "block int, counts binary", make), "toxicity-counts")
    total = summed_counts(parts.filter(F.col("block") == 2 * BLOCKS).withColumn("block", F.lit(0)), 1, "<u4")
    counts = summed_counts(parts.filter(F.col("block") < 2 * BLOCKS), 2 * BLOCKS, "<u4")
    counts = (counts if len(counts) else np.zeros(2 * size, np.int64)).reshape(2, size)
    return counts, total if len(total) else np.zeros(2, np.int64)


class Weigher:
    """Word -> the highest weight among its features: the log odds when they are high and a likelihood-ratio test leaves
    no room for chance, less when either is lower, 0 for the rest.

    A feature's documents of either label are the least count among its buckets.  Collisions
    only ever add to a count, so clean documents are never understated, whatever the input size.
    """

    def __init__(self, counts: np.ndarray, total: np.ndarray):
        self.clean, self.toxic = counts
        self.n_clean, self.n_toxic = total.tolist()

    def weight(self, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Weights of features by their documents of either label (``toxic`` above 0)."""
        share = self.n_toxic / (self.n_clean + self.n_toxic)
        both = clean + toxic
        g = toxic * np.log(toxic / (both * share)) + clean * np.log(np.maximum(clean, 1) / (both * (1 - share)))
        odds = np.log((toxic + .5) / (self.n_toxic + 1)) - np.log((clean + .5) / (self.n_clean + 1))
        shrunk = np.log((toxic + PRIOR * share) / share) - np.log((clean + PRIOR * (1 - share)) / (1 - share)) - LESS
        likely = np.where((2 * g > LIKELY) & (odds > LIKELY_ODDS), np.maximum(shrunk, 0), 0)
        return np.where((2 * g > BEYOND) & (odds > ODDS), odds, likely)

    def weights(self, words: list[str]) -> list[float]:
        """The weight of each word; all words' features are looked up together."""
        best = np.zeros(len(words))
        if words and self.n_clean and self.n_toxic:
            found = [features(w) for w in words]
            owner = np.repeat(np.arange(len(words)), [len(f) for f in found])
            at = _buckets(np.array([h for f in found for h in f], np.uint64))
            toxic = self.toxic[at].min(axis=0)
            some = np.flatnonzero(toxic)                     # most features are in no toxic document
            np.maximum.at(best, owner[some], self.weight(self.clean[at[:, some]].min(axis=0).astype(float), toxic[some].astype(float)))
        return best.tolist()

    def __call__(self, word: str) -> float:
        return self.weights([word])[0]


class WordWeights(dict):
    """word -> weight, remembered; new words are weighed a batch at a time, and the memory starts anew when it is full."""

    def __init__(self, weigh: Weigher, size: int = 1 << 18):
        self.weigh, self.size = weigh, size

    def sums(self, texts_words: list[set[str]]) -> list[float]:
        """The summed weights of each set of words."""
        if len(self) >= self.size:
            self.clear()
        new = [w for w in set().union(*texts_words) if w not in self]
        self.update(zip(new, self.weigh.weights(new)))
        return [math.fsum(map(self.__getitem__, words)) for words in texts_words]


#: Sums of weights are counted by quarter steps up to this bin.
TOP_BIN = 200


def raw_scores(df: DataFrame, costs: np.ndarray, counts: np.ndarray, total: np.ndarray) -> DataFrame:
    """(doc_id, bin): quarter steps of the summed weights of each text's distinct restored words."""
    kind = df.schema["doc_id"].dataType.simpleString()
    counts = counts.astype(np.uint32)

    def make():
        restore = Restorer(costs)
        memory = Generations(restore, 1 << 17)
        known = WordWeights(Weigher(counts, total))

        def step(batch):
            sums = known.sums([restore.words(t, memory) for t in texts(batch.column(1))])
            bins = [min(TOP_BIN, int(4 * x)) for x in sums]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins, pa.int32())], ["doc_id", "bin"])
        return step

    return map_rows(df.select("doc_id", "text"), f"doc_id {kind}, bin int", make)


def curve(clean: np.ndarray, toxic: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Score of each bin: a logistic curve on its square root, rising, smoothed by one document at either end."""
    x = np.sqrt(np.arange(TOP_BIN + 1) / 4.0)
    clean, toxic = clean.astype(float), toxic.astype(float)
    clean[0] += 1
    toxic[-1] += 1
    a, b = 0.0, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        n, g = clean + toxic, toxic - (clean + toxic) * p
        v = n * p * (1 - p) + 1e-9
        h = np.array([[v.sum(), v @ x], [v @ x, v @ (x * x)]]) + np.eye(2) * 1e-3
        da, db = np.linalg.solve(h, [g.sum() - 1e-3 * a, g @ x - 1e-3 * b])
        a, b = a + float(np.clip(da, -1, 1)), b + float(np.clip(db, -1, 1))
        if abs(da) + abs(db) < 1e-8:
            break
    return 1 / (1 + np.exp(-np.clip(a + max(b, 1e-3) * x, -30, 30)))


def score(docs: DataFrame, labels: DataFrame, held_out: int = 2, folds: int = 4, threshold: float = .3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic 0 or 1) teach the scorer, but for documents with
    crc32(doc_id as text) mod ``folds`` = ``held_out``.  Labels that are null or
    neither 0 nor 1 teach nothing; of several labels of an id the largest holds.
    Without labels of both kinds all weights are 0.  A null or empty text has no
    words, and the score of its bin.  A null doc_id is not held out and is never
    labelled.  Repeated rows get a row each; each of them teaches.  Texts of any length
    are read whole; an empty table gives no rows.  Other columns are left out.
    """
    docs = docs.select("doc_id", "text")
    fold = lambda c: F.coalesce(F.crc32(c.cast("string")) % folds == held_out, F.lit(False))
    taught = (labels.filter("doc_id is not null and toxic in (0, 1)").filter(~fold(F.col("doc_id")))
                    .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    taught = stage(taught, "toxicity-labels")
    costs = language_model(trigram_counts(docs))
    counts, total = feature_counts(docs.join(sized(taught, 16), "doc_id").select("text", "toxic"), costs)
    raw = stage(raw_scores(docs, costs, counts, total), "toxicity-raw")
    per_bin = raw.join(sized(taught, 16), "doc_id").groupBy("bin", "toxic").count().collect()  # two rows a bin at most
    counts = np.zeros((2, TOP_BIN + 1))
    for b, toxic, n in per_bin:
        counts[toxic, b] = n
    values = curve(*counts).tolist()
    p = F.element_at(F.array(*map(F.lit, values)), F.col("bin") + 1)
    return raw.select("doc_id", fold(F.col("doc_id")).alias("held_out"), p.alias("score"), (p >= threshold).cast("int").alias("predicted"))
