"""Operator 9: exact Jaccard self-join of word-shingle sets, size-aware, heavy and light.

Equal sets are folded into their smallest id first.  Then:

* Small sets (up to a boundary size) enumerate fixed-size subsets: two sets of
  sizes s and t link exactly when they share a subset of ceil(3(s + t) / 7)
  shingles, so all of those subsets, under the key (s, t, subset), find the links
  without any further check.
* Large sets scan inverted lists.  Shingles are ordered by how often their hash
  bucket occurs (rare first); the first n - ceil(3n/4) + 1 shingles of a set must
  hold one of any set it links with.  Lists of one set are dropped as they
  stream by.
* The boundary is where enumerating costs more than scanning, from the counted
  sets per size and the mean list length that the bucket counts give.

Links are wanted as components, so the scan verifies exactly, on whole texts,
first one candidate per set (the head of a list that it shares most lists with),
then in rounds one pair per component (the one that shares most lists with another
one), and at last every candidate pair that is still in different components.  A pair is given up only if the shared lists prove that it cannot
reach 3/4: of two sets, all common shingles among the first ones of the set whose
first ones end earlier are seen, so the others of these are missing from the
other set.  The bound is taken with the open lists that two sets can share by
their bitmaps, so most pairs are ruled out before they are made, and a pair is
made only under lists that leave room for as many common lists behind them.
Lists of any length are cut into blocks, pairs of blocks are joined.
"""

from __future__ import annotations

import hashlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import (count_blocks, discard, map_rows, mix64, ngram_hashes, signed, sized, stage, summed_counts, texts,
                     word_hashes)
from .graph import components

WORDS = 5
#: Buckets of the shingle counts: a table of fixed size, 256 KB as classes.
BUCKET_BITS, BLOCKS = 18, 64
#: No size above this is considered for enumeration.
MAX_SMALL = 16
#: Rows of a list that are joined at a time.
LIST_BLOCK = 2048


def shingles(words: np.ndarray) -> np.ndarray:
    """The distinct shingle hashes of a word-hash sequence, sorted."""
    if not len(words):
        return np.empty(0, np.uint64)
    every = np.sort(ngram_hashes(words, min(WORDS, len(words))))
    return every[np.concatenate([[True], every[1:] != every[:-1]])]


def shingle_set(text: str) -> np.ndarray:
    """The shingle set of a text; words end at ASCII white space, A-Z are lowered."""
    return shingles(word_hashes(text.encode().lower()))


def least_overlap(s: int, t: int) -> int:
    """The smallest overlap of linked sets of sizes ``s`` and ``t``."""
    return -(-3 * (s + t) // 7)


def partner_sizes(s: int) -> list[int]:
    return [t for t in range(1, s + s // 3 + 2) if least_overlap(s, t) <= min(s, t)]


def subset_cost(s: int, boundary: int) -> int:
    """Subsets that a set of size ``s`` enumerates if sets up to ``boundary`` are small."""
    return sum(comb(s, least_overlap(s, t)) for t in partner_sizes(s) if min(s, t) <= boundary)


def prefix_length(n):
    return n - (3 * n + 3) // 4 + 1


# ------------------------------------------------------------- first reading
def _read_sets(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, digest) of every row, and the counts of shingles per hash bucket over all rows."""
    names = ["doc_id", "n", "digest", "block", "counts"]

    def make():
        counts = np.zeros(1 << BUCKET_BITS, np.int64)

        def step(batch):
            found = [shingle_set(t) for t in texts(batch.column(1))]
            every = np.concatenate([np.empty(0, np.uint64), *found])
            counts[:] += np.bincount((every >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(counts))
            digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, found), pa.int64()), pa.array(digests, pa.binary()),
                pa.nulls(len(found), pa.int32()), pa.nulls(len(found), pa.binary())], names)

        def close():
            block, data = count_blocks(counts, BLOCKS)
            empty = lambda kind: pa.nulls(BLOCKS, kind)
            return [pa.RecordBatch.from_arrays([empty(pa.int64()), empty(pa.int64()), empty(pa.binary()), block, data], names)]
        step.close = close
        return step

    both = stage(map_rows(docs, "doc_id bigint, n bigint, digest binary, block int, counts binary", make), "jaccard-sets")
    counts = summed_counts(both.filter("block is not null"), BLOCKS)
    return both.filter("block is null").select("doc_id", "n", "digest"), counts


def _classes(counts: np.ndarray) -> np.ndarray:
    """Bucket -> half-octave class of its count, 0 to 63: rare buckets sort first."""
    return np.minimum(63, np.floor(2 * np.log2(counts + 1.0))).astype(np.uint8)


def _boundary(groups: DataFrame, counts: np.ndarray) -> int:
    """The largest size up to which enumerating subsets costs no more than scanning lists."""
    total = float(counts.sum())
    if not total:
        return 0
    mean_list = max(1.0, float((counts.astype(float) ** 2).sum()) / total - total / len(counts))
    of_size = dict(groups.filter(F.col("n") <= 2 * MAX_SMALL).groupBy("n").count().collect())  # at most 2 * MAX_SMALL rows
    best = 0
    for x in range(1, MAX_SMALL + 1):
        small = sum(k * subset_cost(s, x) for s, k in of_size.items())
        lists = sum(k * prefix_length(s) * (1 + mean_list) for s, k in of_size.items() if s <= x)
        if small <= lists:
            best = x
    return best


# ------------------------------------------------------------ second reading
def _signatures(reps: DataFrame, classes: np.ndarray, boundary: int) -> DataFrame:
    """List rows (kind 0: key, rep, n, last key of the first ones) and subset rows (key and last are the
    hash; kind 1 for pairs of one size, kind 2 for pairs of two sizes)."""
    names = ["kind", "key", "rep", "n", "last"]

    def make():
        def ordered(x: np.ndarray) -> np.ndarray:
            """Shingles as keys whose order is rare buckets first: class, then 57 bits of the hash."""
            bucket = classes[(x >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64)
            return np.sort((bucket << np.uint64(57)) | (mix64(x) >> np.uint64(7)))

        def subsets(x: np.ndarray):
            s = len(x)
            for t in partner_sizes(s):
                if min(s, t) <= boundary:
                    mark = bytes((min(s, t), max(s, t)))
                    for part in combinations(x.tolist(), least_overlap(s, t)):
                        h = hashlib.blake2b(mark + np.array(part, np.uint64).tobytes(), digest_size=16).digest()
                        yield 1 if s == t else 2, int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)

        def step(batch):
            keys, ids, sizes, lasts, kinds = [], [], [], [], []
            for d, t in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                x = shingle_set(t)
                n = len(x)
                if n > boundary:
                    k = ordered(x)[:prefix_length(n)]
                    keys.append(signed(k))
                    lasts.append(np.full(len(k), signed(k)[-1]))
                    kinds.append(np.zeros(len(k), np.int8))
                    ids.append(np.full(len(k), d))
                    sizes.append(np.full(len(k), n))
                if 0 < n <= boundary + boundary // 3 + 1 and (sub := list(subsets(x))):
                    kind, a, b = zip(*sub)
                    keys.append(np.array(a, np.int64))
                    lasts.append(np.array(b, np.int64))
                    kinds.append(np.array(kind, np.int8))
                    ids.append(np.full(len(a), d))
                    sizes.append(np.full(len(a), n))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in (
                    (kinds, pa.int8()), (keys, pa.int64()), (ids, pa.int64()), (sizes, pa.int64()), (lasts, pa.int64()))], names)
        return step

    return map_rows(reps, "kind tinyint, key bigint, rep bigint, n bigint, last bigint", make)


class _Shared:
    """Streams rows sorted by key, kind and size and lets through those whose list has two rows or more, with the list's first row.

    A subset's list (kinds 1 and 2) is that of its whole hash, the key and ``last``.

    Sets of a key that are too different in size cannot link: where the next size is
    beyond 4/3 of the last one, another list begins, under a key of its own.  Sets that
    can link have no such step between them.
    """

    NAMES = ["kind", "key", "rep", "n", "last", "head", "head_n", "head_last"]

    def __init__(self):
        self.held = None  # the last row seen, its key's first row, and whether its key had a row before it

    def __call__(self, batch: pa.RecordBatch):
        kind, key, rep, n, last = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(key):
            return
        before = False
        if self.held is not None:
            row, head, before = self.held
            kind, key, rep, n, last = (np.concatenate([[v], c]) for v, c in zip(row, (kind, key, rep, n, last)))
        step = np.where(kind[1:] == 0, 4 * n[:-1] < 3 * n[1:], last[1:] != last[:-1])
        start = np.concatenate([[True], (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]) | step])
        first = np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))
        heads = [rep[first], n[first], last[first]]
        if before:
            own = first == 0
            heads = [np.where(own, h, c) for h, c in zip(head, heads)]
        prev = ~start
        prev[0] = before
        self.held = ((kind[-1], key[-1], rep[-1], n[-1], last[-1]), tuple(c[-1] for c in heads), bool(prev[-1]))
        more = np.concatenate([~start[1:], [False]])
        keep = (prev | more)[:-1]
        yield self._rows(*(c[:-1][keep] for c in (kind, key, rep, n, last, *heads)))

    def close(self):
        if self.held is not None and self.held[2]:
            row, head, _ = self.held
            yield self._rows(*(np.array([v]) for v in (*row, *head)))

    def _rows(self, kind, key, *others):
        own = signed(mix64(key.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * others[4].astype(np.uint64)))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (kind, np.where(kind == 0, own, key), *others)], self.NAMES)


def _lists(rows: DataFrame) -> DataFrame:
    """The rows of lists and of subsets that two sets or more hold; all kinds go through one shuffle, nothing is written before it."""
    # the head of a list is its smallest set, of several the one with the least hash: the same one for most lists of a family
    whole = F.when(F.col("kind") > 0, F.col("last"))
    ordered = (rows.select(F.col("kind").cast("bigint").alias("kind"), "key", "rep", "n", "last").repartition("key")
                   .sortWithinPartitions("key", "kind", whole, "n", F.xxhash64("rep"), "rep"))
    return map_rows(ordered, ", ".join(f"{c} bigint" for c in _Shared.NAMES), _Shared, 1 << 16)


def _small_links(rows: DataFrame) -> DataFrame:
    """Links between sets that share an enumerated subset, as stars.

    Under a key for two sizes only sets of different sizes link: those of one
    size go to the least id of the other size, which connects the same sets.
    """
    least = (rows.groupBy("kind", "key", "last")
                 .agg(F.min(F.struct("n", "rep")).alias("lo"), F.min(F.struct((-F.col("n")).alias("n"), "rep")).alias("hi"),
                      F.count(F.lit(1)).alias("rows"))
                 .filter("rows > 1 and (kind = 1 or lo.n < -hi.n)"))
    other = F.when((F.col("kind") == 1) | (F.col("n") > F.col("lo.n")), F.col("lo.rep")).otherwise(F.col("hi.rep"))
    return (rows.join(least, ["kind", "key", "last"]).select(other.alias("a"), F.col("rep").alias("b"))
                .filter("a != b").distinct())


# ------------------------------------------------------------------ checking
def verified(pairs: DataFrame, docs: DataFrame) -> tuple[DataFrame, int, int]:
    """Those of the pairs (a, b) whose texts' sets link, by exact comparison of whole sets; how many pairs there were and are."""
    pairs = stage(pairs.select("a", "b"), "jaccard-pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    ids = stage(ids, "jaccard-pair-ids")
    found = stage(docs.join(sized(ids, 32), "doc_id", "left_semi"), "jaccard-pair-texts")
    both = (pairs.join(found.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b")
                 .join(found.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a"))

    def make():
        known = {}

        def get(text):
            if text not in known:
                if len(known) >= 256:
                    known.clear()
                known[text] = shingle_set(text)
            return known[text]

        def step(batch):
            keep = []
            for ta, tb in zip(texts(batch.column(2)), texts(batch.column(3))):
                x, y = get(ta), get(tb)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(common) and 100 * common >= 75 * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])
        return step

    links = stage(map_rows(both.select("a", "b", "ta", "tb"), "a bigint, b bigint", make, 128).distinct(), "jaccard-links")
    tried = pairs.count()
    discard(pairs, ids, found)
    return links, tried, links.count()


#: Rounds, at most, that try a few pairs for each component before all open pairs are looked at: one in the first, then
#: TRIES; after two, another round is made while a quarter of the last one's pairs linked, so that it pays.
ROUNDS, TRIES = 8, 16
#: Rows of lists with one head that go to one task together.
FAMILY_ROWS = 1 << 19
#: 64-bit words of the bitmap of a set's open lists.
MAP_WORDS = 8


def _can_link(na: Column, nb: Column, la: Column, lb: Column, sa: Column, sb: Column) -> Column:
    """Whether sets of sizes ``na``, ``nb`` that share at most min(``sa``, ``sb``) of their first
    shingles can link; ``la``, ``lb`` are the last of these.

    Of the set whose first shingles end earlier, those not shared are missing from
    the other set, and the overlap must come to 3(na + nb) / 7 without them.
    """
    need, most = F.ceil(3 * (na + nb) / 7), F.least(sa, sb)
    rest = lambda n: F.floor((3 * n + 3) / 4) - 1  # noqa: E731  shingles after the first ones
    return (((la > lb) | (rest(na) + most >= need)) & ((lb > la) | (rest(nb) + most >= need))
            & (4 * F.least(na, nb) >= 3 * F.greatest(na, nb)))


def _least_shared(na, nb, la, lb):
    """How many of their first shingles sets must share to link, as arrays; at least 1."""
    need = -(-3 * (na + nb) // 7)
    return np.maximum(1, np.maximum(np.where(la <= lb, need - na + prefix_length(na), 1),
                                    np.where(lb <= la, need - nb + prefix_length(nb), 1)))


class _Pairs:
    """Joins the rows of whole lists (or pairs of blocks of one), sorted by list: pairs of different components that can link.

    All of them (a, b), or with ``best`` for each component as many pairs (comp, score, a, b), those that share
    most lists for their size with a set of another one.
    """

    BATCH = 1 << 16

    def __init__(self, best: int = 0):
        self.best, self.names = best, ["comp", "score", "a", "b"] if best else ["a", "b"]
        self.rows: list[np.ndarray] = []
        self.size = 0
        self.held: list[np.ndarray] = []
        self.count = 0

    def __call__(self, batch: pa.RecordBatch):
        self.rows.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        self.size += batch.num_rows
        if self.size >= self.BATCH:
            rows = np.concatenate(self.rows, axis=1)
            same = (rows[:3] == rows[:3, -1:]).all(0)  # the last list may go on
            cut = rows.shape[1] - int(same[::-1].cumprod().sum())
            self.rows, self.size = [rows[:, cut:]], rows.shape[1] - cut
            yield from self._join(rows[:, :cut])

    def close(self):
        if self.rows:
            yield from self._join(np.concatenate(self.rows, axis=1))
        if self.held:
            yield self._emit(self._distinct())

    def _join(self, rows: np.ndarray):
        key, i, j, side, rep, n, last, comp, open_, rank, *bits = rows
        bits = np.stack(bits).view(np.uint64)
        hidden = open_ - np.bitwise_count(bits).sum(0, dtype=np.int64)  # lists that share a bit with another of the set
        at, step = np.arange(len(key)), 0
        while True:
            step += 1
            at = at[at + step < len(key)]
            to = at + step
            same = (key[at] == key[to]) & (i[at] == i[to]) & (j[at] == j[to])
            at, to = at[same], to[same]
            if not len(at):
                break
            ok = (comp[at] != comp[to]) & (rep[at] != rep[to]) & ((i[at] == j[at]) | (side[at] != side[to]))
            x, y = at[ok], to[ok]
            both = np.bitwise_count(bits[:, x] & bits[:, y]).sum(0, dtype=np.int64)
            most = np.minimum(np.minimum(open_[x], open_[y]), both + np.minimum(hidden[x], hidden[y]))
            # the pair's first common list, rare lists first, leaves room for the others behind it
            least = _least_shared(n[x], n[y], last[x], last[y])
            ok = ((most >= least) & (4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y]))
                  & (rank[x] <= open_[x] - least + 1) & (rank[y] <= open_[y] - least + 1))
            x, y = x[ok], y[ok]
            if self.best:
                score = 4096 * both[ok] // np.maximum(n[x], n[y])
                self.held += [np.stack([comp[p], score, rep[x], rep[y]]) for p in (x, y)]
            else:
                self.held.append(np.stack([np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])]))
            self.count += len(x)
            if self.count >= 1 << 18:
                # a pair turns up in many lists of one family, which follow each other: most are copies
                pairs = self._distinct()
                self.held, self.count = [pairs], pairs.shape[1]
                if self.count >= 1 << 17:
                    yield self._emit(pairs)
                    self.held, self.count = [], 0

    def _distinct(self) -> np.ndarray:
        pairs = np.concatenate(self.held, axis=1)
        if self.best:
            pairs = pairs[:, np.lexsort((pairs[3], pairs[2], -pairs[1], pairs[0]))]
            pairs = pairs[:, np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(0)])] if pairs.shape[1] else pairs
            nth = np.arange(pairs.shape[1]) - np.searchsorted(pairs[0], pairs[0])
            return pairs[:, nth < self.best]
        pairs = pairs[:, np.lexsort(pairs[::-1])]
        return pairs[:, np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(0)])] if pairs.shape[1] else pairs

    def _emit(self, pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs], self.names)


def _with_components(lists: DataFrame, comps: DataFrame) -> DataFrame:
    comps = sized(comps.withColumnRenamed("node", "rep"), 32)
    return (lists.select("key", "rep", "n", "last", "head").join(comps, "rep", "left")
                 .select("key", "rep", "n", "last", "head", F.coalesce("component", "rep").alias("comp")))


def _open_keys(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """(key, rows) of the lists that hold two components or more; ``rows`` is the list's length."""
    return (_with_components(lists, comps).groupBy("key")
            .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows"))
            .filter("lo < hi").select("key", "rows"))


def _open_lists(lists: DataFrame, comps: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, rep, n, last, head, comp, rows) of the lists named by ``keys``."""
    return _with_components(lists, comps).join(sized(keys, 32), "key")


def _with_maps(rows: DataFrame) -> DataFrame:
    """Open rows with ``open`` (open lists that hold the set), ``rank`` (the list's place among these, short lists first) and bitmap words.

    No pair across components shares more lists than ``open``, or than its bitmaps allow.
    """
    bit = F.pmod(F.xxhash64("key"), F.lit(64 * MAP_WORDS))
    words = [F.bit_or(F.when(F.floor(bit / 64) == w, F.expr("shiftleft(1L, cast(pmod(xxhash64(key), 64) as int))"))
                      .otherwise(F.lit(0).cast("bigint"))).alias(f"m{w}") for w in range(MAP_WORDS)]
    per_set = rows.groupBy("rep", "n").agg(F.count(F.lit(1)).alias("open"), *words)
    order = Window.partitionBy("rep", "n").orderBy("rows", "key")  # a set's lists: no more than its shingles
    return rows.withColumn("rank", F.row_number().over(order).cast("bigint")).join(per_set, ["rep", "n"])


def _open_pairs(rows: DataFrame, best: int = 0) -> DataFrame:
    """All candidate pairs (a, b) of different components that the shared lists cannot rule out; with ``best`` so many for each component.

    Lists with one head, a family's, are worked on by one task one after the other, up to FAMILY_ROWS rows, so that the
    pairs that come up in many of them are made once.
    """
    families = rows.groupBy("head").agg(F.ceil(F.count(F.lit(1)) / FAMILY_ROWS).alias("parts"))
    blocks = F.ceil(F.col("rows") / LIST_BLOCK)
    rows = rows.join(sized(stage(families, "jaccard-families"), 32), "head").withColumn("part", F.pmod(F.xxhash64("key"), "parts"))
    rows = rows.select("*", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).alias("side"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = (rows.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")})
                .repartition("head", "part", "i", "j").sortWithinPartitions("head", "part", "key", "i", "j")
                .select("key", "i", "j", "side", "rep", "n", "last", "comp", "open", "rank", *(f"m{w}" for w in range(MAP_WORDS))))
    pairs = map_rows(rows, ", ".join(f"{c} bigint" for c in _Pairs(best).names), lambda: _Pairs(best), 1 << 14)
    if best:
        pairs = pairs.select("comp", "score", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        order = Window.partitionBy("comp").orderBy(F.desc("score"), "a", "b")
        pairs = pairs.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= best).select("a", "b")
    return pairs.distinct()


# ------------------------------------------------------------------ operator
def components_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    Two documents link when the Jaccard similarity of their sets of distinct
    5-word shingles is 3/4 or more.  A null or empty text has an empty set and
    links with nothing; a row whose id is null links with nothing and has a null
    component.  Rows that repeat an id are one document and share a component.
    Other columns are left out.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sets, counts = _read_sets(docs)
    whole = sets.filter("doc_id is not null and n > 0")
    groups = stage(whole.groupBy("digest", "n").agg(F.min("doc_id").alias("rep")), "jaccard-groups")
    named = sized(groups.select("digest", "rep"), 64)
    copies = stage(whole.join(named, "digest").filter("doc_id != rep").select("doc_id", "rep"), "jaccard-copies")
    repeats = whole.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeats = stage(whole.join(repeats, "doc_id").join(named, "digest").select("doc_id", "rep"), "jaccard-repeats")

    boundary = _boundary(groups, counts)
    # rows of an id that is a representative for one of its texts stay
    others = copies.select("doc_id").distinct().join(groups, F.col("doc_id") == F.col("rep"), "left_anti")
    docs = docs.filter("doc_id is not null")
    reps = docs.join(sized(stage(others, "jaccard-others"), 16), "doc_id", "left_anti")
    shared = stage(_lists(_signatures(reps, _classes(counts), boundary)), "jaccard-lists")
    lists = shared.filter("kind = 0")

    edges = repeats.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    if boundary:
        edges = edges.unionByName(_small_links(shared.filter("kind > 0")))

    # the count of lists that a set shares with a head leaves out common lists with another head: a guess, the last turn is exact
    stars = (lists.filter("rep != head").groupBy("rep", "n", "last", "head", "head_n", "head_last").count()
                  .filter(_can_link(*(F.col(c) for c in ("n", "head_n", "last", "head_last", "count", "count"))))
                  .groupBy("rep").agg(F.max(F.struct("count", F.col("head").alias("a"))).alias("best"))
                  .select(F.col("best.a").alias("a"), F.col("rep").alias("b")))
    found, tried, linked = verified(stars, docs)
    edges = stage(edges.unionByName(found), "jaccard-first-links")
    comps = stage(components(edges, "a", "b"), "jaccard-components")
    as_edges = lambda c: c.select(F.col("node").alias("a"), F.col("component").alias("b"))  # noqa: E731  stand for all links so far
    discard(found)
    for turn in range(ROUNDS + 1):
        keys = stage(_open_keys(lists, comps), "jaccard-open-keys")
        rows = lists = stage(_open_lists(lists, comps, keys), "jaccard-open-sets")  # a list once closed stays closed
        discard(shared, keys)
        shared = rows
        # the last turn looks at all open pairs; those before it join components, most of whose pairs need no look then
        last = turn == ROUNDS or turn > 1 and 4 * linked < tried
        found, tried, linked = verified(_open_pairs(_with_maps(rows), 0 if last else TRIES if turn else 1), docs)
        if linked:
            comps = stage(components(as_edges(comps).unionByName(found), "a", "b"), "jaccard-components")
        discard(found)
        if last:
            break

    by_group = (groups.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
                      .select("digest", F.coalesce("component", "rep").alias("component_id")))
    by_group = sized(stage(by_group, "jaccard-named"), 64)
    out = sets.withColumn("digest", F.when(F.col("doc_id").isNotNull(), F.col("digest")))
    return out.join(by_group, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one document of each component: the smallest id, once.

    Rows with a null id all stay; of rows that repeat a kept id the first by text stays.
    """
    found = stage(components_of(df, id_col, text_col), "jaccard-result").filter("doc_id is not null")
    kept = found.groupBy("doc_id").agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("rows"))
    kept = stage(kept.select(F.col("doc_id").alias(id_col), (F.col("c") < F.col("doc_id")).alias("gone"), "rows"), "jaccard-kept")
    gone = sized(kept.filter("gone").select(id_col), 16)
    left = df.join(gone, id_col, "left_anti")
    again = stage(kept.filter("not gone and rows > 1").select(id_col), "jaccard-again")
    if not again.count():
        return left
    once = (left.join(again, id_col, "left_semi")
                .groupBy(id_col).agg(F.min_by(F.struct(*df.columns), F.coalesce(text_col, F.lit(""))).alias("row")).select("row.*"))
    return left.join(again, id_col, "left_anti").unionByName(once)


#: DuckDB SQL for the registered query: sets that share a shingle, then everything reachable.
SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM worded),
rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS both_
  FROM rows_ a JOIN rows_ b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * both_ >= 75 * (na + nb - both_)),
reach(node, other) AS (
  SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
least_of AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(low, s.doc_id)) AS component_id
FROM sets s LEFT JOIN least_of l ON l.node = s.doc_id"""
