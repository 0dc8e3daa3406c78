"""Operator 6: repeated word windows by prefix-partitioned suffix trees.

The suffixes that matter start a window of ``window`` words.  Each belongs to
the group of its anchor: the run of ``anchor`` words inside the window with the
least hash (leftmost of equals), so equal windows meet in one group wherever
they stand.  Groups of one row hold no repeat and are dropped as they stream by.

* A group of bounded size is sent to a task as the stretches of text around its
  anchors.  The task builds the depth-limited suffix tree of whole groups by
  prefix doubling: the rank of a suffix at depth 1, 2, 4, ... names the tree
  node that it hangs from at that depth.  The nodes at depth ``window`` with two
  leaves or more are the deep internal nodes: their leaves repeat, and all but
  those of the smallest document are marked.
* A group that is larger is split by a longer prefix: the windows that reach far
  to the right of the anchor by its first 24 words, those that reach far to the
  left by the 16 words before it and its own.  Groups that are still larger are
  split by the whole window: each window is a group of its own, whose smallest
  document is found by an aggregate with map-side partial results, so no task
  ever holds it.

Documents with equal texts are folded into the smallest id first: all windows
of the others repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import WordHash, map_rows, ngram_hashes, signed, sized, stage, texts

#: Rows of a group that one task takes; larger groups are split by longer prefixes.
GROUP_ROWS = 16384
#: Words of a longer prefix, to the right and to the left of an anchor's first word.
RIGHT, LEFT = 24, 16
#: Words of whole groups that are ranked at a time.
TREE_WORDS = 1 << 21


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost least value of each run of ``width`` values stands, by doubling."""
    at, have = np.arange(len(x)), 1
    while have < width:
        shift = min(have, width - have)
        left, right = at[:len(at) - shift], at[shift:]
        at = np.where(x[right] < x[left], right, left)
        have += shift
    return at


class _Windows:
    """text -> words, and for each window start the position of its anchor."""

    def __init__(self, window: int, anchor: int):
        self.window, self.anchor, self.hashes = window, anchor, WordHash()

    def __call__(self, text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        words = text.encode().split()
        if len(words) < self.window:
            return words, np.empty(0, np.int64), np.empty(0, np.uint64)
        h = ngram_hashes(self.hashes.array(words), self.anchor)
        return words, _least(h, self.window - self.anchor + 1), h


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(key, doc_id, at): the anchors of all windows; ``key`` is the hash of the anchor's words."""
    def make():
        windows = _Windows(window, anchor)

        def step(batch):
            keys, ids, ats = [], [], []
            for d, t in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                _, least, h = windows(t)
                if len(least):
                    at = least[np.concatenate([[True], least[1:] != least[:-1]])]
                    keys.append(signed(h[at]))
                    ids.append(np.full(len(at), d))
                    ats.append(at)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids)),
                                                  pa.array(np.concatenate(ats), pa.int32())], ["key", "doc_id", "at"])
        return step

    return map_rows(docs, "key bigint, doc_id bigint, at int", make)


def _repeated(anchors: DataFrame) -> DataFrame:
    """(key, doc_id, at, rows) of the anchors that two documents or more hold; ``rows`` counts the key's."""
    keys = (anchors.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("rows"))
                   .filter("lo < hi").select("key", "rows"))
    return anchors.join(keys, "key")


def _stretches(docs: DataFrame, shared: DataFrame, window: int, anchor: int, group_rows: int) -> DataFrame:
    """(hot, key, doc_id, tag, at, first, windows, words): for each shared anchor the stretch that its windows cover."""
    names = ["hot", "key", "doc_id", "tag", "at", "first", "windows", "words"]
    places = (shared.groupBy("doc_id").agg(F.collect_list(F.struct("at", (F.col("rows") > group_rows).alias("hot"))).alias("places")))
    both = docs.join(places.hint("merge"), "doc_id")  # as large as the repeated part of the input: never broadcast

    def make():
        find = _Windows(window, anchor)

        def step(batch):
            out: list[tuple] = []
            for d, tag, t, places in zip(*(c.to_pylist() for c in batch.columns)):
                words, least, h = find(t)
                if not len(least):
                    continue
                begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
                end = np.append(begin[1:], len(least))
                hot = {p["at"]: p["hot"] for p in places}
                for lo, hi in zip(begin.tolist(), end.tolist()):
                    at = int(least[lo])
                    if at in hot:
                        out.append((hot[at], int(signed(h[at:at + 1])[0]), d, tag, at, lo, hi - lo, b" ".join(words[lo:hi - 1 + window])))
                if len(out) >= 8192:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)

        def rows(out):
            types = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        return step

    return map_rows(both.select("doc_id", "tag", "text", "places"),
                    "hot boolean, key bigint, doc_id bigint, tag bigint, at int, first int, windows int, words binary", make, 128)


# --------------------------------------------------------------------- trees
def node_at_depth(x: np.ndarray, depth: int) -> np.ndarray:
    """For each position of ``x`` the node of the suffix tree at ``depth`` words, by prefix doubling.

    Positions less than ``depth`` words from the end get nodes of their own.
    """
    rank, have = np.unique(x, return_inverse=True)[1].astype(np.int64), 1
    while have < depth:
        shift = min(have, depth - have)
        other = np.concatenate([rank[shift:], -np.arange(1, shift + 1)])  # past the end: unlike any other
        rank = np.unique((rank << 32) + other, return_inverse=True)[1].astype(np.int64)
        have += shift
    return rank


class _Trees:
    """Marks (doc_id, tag, lo, hi) word ranges of repeats, from stretches sorted by group key."""

    NAMES = ["doc_id", "tag", "lo", "hi"]

    def __init__(self, window: int, words: int):
        self.window, self.limit = window, words
        self.held: list[tuple] = []
        self.size = 0

    def __call__(self, batch: pa.RecordBatch):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if self.size >= self.limit and row[0] != self.held[-1][0]:
                yield from self.close()
            self.held.append(row)
            self.size += row[4] + self.window

    def close(self):
        if not self.held:
            return
        _, docs, tags, firsts, counts, words = zip(*self.held)
        self.held, self.size = [], 0
        ids: dict[bytes, int] = {}
        parts, sizes = [], []
        for w in words:
            w = w.split(b" ")
            parts.append([ids.setdefault(x, len(ids)) for x in w])
            sizes.append(len(w))
        flat = np.concatenate([np.array(p, np.int64) for p in parts])
        begin = np.cumsum([0, *sizes[:-1]])
        counts, docs = np.array(counts), np.array(docs)
        row = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        node = node_at_depth(flat, self.window)[begin[row] + offset]
        least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, docs[row])
        again = docs[row] > least[node]
        yield from _ranges(docs[row][again], np.array(tags)[row][again], np.array(firsts)[row][again] + offset[again], self.window)


def _ranges(docs: np.ndarray, tags: np.ndarray, starts: np.ndarray, window: int):
    """Word ranges that the windows at ``starts`` cover, neighbours joined."""
    if not len(docs):
        return
    order = np.lexsort((starts, tags, docs))
    docs, tags, starts = docs[order], tags[order], starts[order]
    new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (tags[1:] != tags[:-1]) | (starts[1:] > starts[:-1] + window)])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(docs) - 1)
    yield pa.RecordBatch.from_arrays([pa.array(docs[new], pa.int64()), pa.array(tags[new], pa.int64()), pa.array(starts[new], pa.int32()),
                                      pa.array(starts[last] + window, pa.int32())], _Trees.NAMES)


def _split(stretches: DataFrame, window: int, anchor: int) -> DataFrame:
    """The stretches cut in two by which side of the anchor their windows reach, keyed by the longer prefix of each."""
    names = ["key", "doc_id", "tag", "first", "windows", "words"]
    middle = window - RIGHT - 5  # windows that start this far before the anchor still hold RIGHT words from it on

    def make():
        def step(batch):
            out = []
            for key, d, tag, at, first, n, words in zip(*(c.to_pylist() for c in batch.columns)):
                w = words.split(b" ")
                cut = min(max(at - middle, first), first + n)
                for lo, hi, part in ((cut, first + n, w[at - first:at - first + RIGHT]),
                                     (first, cut, w[max(0, at - first - LEFT):at - first + anchor])):
                    if lo < hi:
                        side = b"r" if lo == cut else b"l"
                        name = xxhash.xxh3_64_intdigest(side + b" ".join(part), seed=key & 0xFFFFFFFF)
                        out.append((name - (1 << 63), d, tag, lo, hi - lo, b" ".join(w[lo - first:hi - 1 - first + window])))
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        return step

    return map_rows(stretches.select("key", "doc_id", "tag", "at", "first", "windows", "words"),
                    "key bigint, doc_id bigint, tag bigint, first int, windows int, words binary", make)


def _hot_windows(stretches: DataFrame, window: int) -> DataFrame:
    """(digest, doc_id, tag, at) of every window of the groups that are split by the whole window."""
    names = ["digest", "doc_id", "tag", "at"]

    def make():
        def step(batch):
            out = []
            for d, tag, first, n, words in zip(*(c.to_pylist() for c in batch.columns)):
                w = words.split(b" ")
                out += [(hashlib.blake2b(b" ".join(w[i:i + window]), digest_size=16).digest(), d, tag, first + i) for i in range(n)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int32()))], names)
        return step

    return map_rows(stretches.select("doc_id", "tag", "first", "windows", "words"),
                    "digest binary, doc_id bigint, tag bigint, at int", make)


# ------------------------------------------------------------------ operator
def repeats(docs: DataFrame, window: int = 50, anchor: int = 8, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, tag, lo, hi): word ranges of ``docs`` (doc_id, tag, text) covered by windows that
    also start in a document with a smaller doc_id; ``tag`` tells rows of one id apart.  Ranges may overlap."""
    shared = stage(_repeated(stage(_anchors(docs.select("doc_id", "text"), window, anchor), "substring-anchors")), "substring-shared")
    stretches = stage(_stretches(docs, shared, window, anchor, group_rows), "substring-stretches")
    cols = ["key", "doc_id", "tag", "first", "windows", "words"]

    def trees(groups: DataFrame) -> DataFrame:
        ordered = groups.select(*cols).repartition("key").sortWithinPartitions("key")
        return map_rows(ordered, "doc_id bigint, tag bigint, lo int, hi int", lambda: _Trees(window, TREE_WORDS), 4096)

    marks, hot = trees(stretches.filter("not hot")), stretches.filter("hot")
    if hot.isEmpty():
        return marks
    parts = stage(_split(hot, window, anchor), "substring-split")
    sizes = parts.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("rows"))
    parts = stage(parts.join(sizes.filter("lo < hi").select("key", "rows"), "key"), "substring-parts")
    marks = marks.unionByName(trees(parts.filter(F.col("rows") <= group_rows)))
    hot = parts.filter(F.col("rows") > group_rows)
    if hot.isEmpty():
        return marks
    windows = stage(_hot_windows(hot, window), "substring-hot")
    least = windows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    again = windows.join(least.select("digest", "least"), "digest").filter("doc_id > least")
    return marks.unionByName(again.select("doc_id", "tag", F.col("at").alias("lo"), (F.col("at") + window).cast("int").alias("hi")))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the text left, words joined by one space.

    Words end at ASCII white space.  A word goes if a window of ``window`` words
    that covers it also starts in a document with a smaller id; windows are
    judged on the input.  A null or empty text has no words.  A row with a null
    id loses nothing and takes nothing from others.  Rows that repeat an id do
    not remove each other's words; each loses what a smaller id holds.  Other
    columns are left out.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tag"))
    named = stage(docs.filter("doc_id is not null and text is not null")
                      .select("doc_id", "tag", F.sha2("text", 256).alias("digest")), "substring-digests")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top")).filter("rep < top")
    copies = stage(named.join(first, "digest").filter("doc_id > rep").select("doc_id", "tag").distinct(), "substring-copies")
    rest = docs.filter("doc_id is not null and text is not null").join(sized(copies, 32), ["doc_id", "tag"], "left_anti")
    marks = repeats(rest.select("doc_id", "tag", "text"), window)
    # a copy of a smaller id loses all words if it has a window at all: a range that begins before the text
    marks = marks.unionByName(copies.select("doc_id", "tag", F.lit(-1).alias("lo"), F.lit(-1).alias("hi")))
    by_doc = stage(marks.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")), "substring-ranges")
    both = docs.join(by_doc.hint("merge"), ["doc_id", "tag"], "left").select("doc_id", "text", "ranges")
    names = ["doc_id", "n_words", "n_removed", "kept"]

    def make():
        def step(batch):
            out = []
            for d, t, ranges in zip(*(c.to_pylist() for c in batch.columns)):
                words = (t or "").encode().split()
                n = len(words)
                if ranges and ranges[0]["lo"] < 0:
                    words = [] if n >= window else words
                elif ranges:
                    gone = np.zeros(n + 1, np.int32)
                    for r in ranges:
                        gone[r["lo"]] += 1
                        gone[r["hi"]] -= 1
                    left = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                    words = [words[i] for i in left]
                out.append((d, n, n - len(words), b" ".join(words).decode()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        return step

    return map_rows(both, "doc_id bigint, n_words bigint, n_removed bigint, kept string", make)


def digest(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of what is kept."""
    return dedup(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB SQL for the registered query: every window of 50 words by its digest.
SQL = r"""
WITH worded AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM worded WHERE len(w) >= 50)),
first_of AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN first_of USING (h) WHERE d < doc_id),
every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM worded),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text_, count(*) AS n FROM every e
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = e.doc_id AND g.i = e.i) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text_, '')) AS kept_sha256
FROM worded d LEFT JOIN kept USING (doc_id)"""
