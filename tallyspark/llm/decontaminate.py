"""Operator 3: benchmark decontamination by size-partitioned MinHash containment search.

DataFrame functions only.  Test items are partitioned by the size of their
shingle set (powers of two).  An item's sketch is the bottom-k MinHash of its
set, k being one more than what an item of its class may miss at the wanted
containment: of those k shingles a document that contains the item must hold at
least one, so probing documents with the sketches loses no pair.  A signature of
the document instead would have to find an item of 30 shingles in a document of
20,000, a Jaccard similarity of 0.0015.

Documents too short for every class are not probed.  Probed pairs are verified
by exact containment: the distinct shingles of the item, as text, that the
document holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from .common import lower_az, sized, sized_lists, stage

WORDS = 5


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lowered, split at ASCII white space; none for null."""
    parts = F.split(lower_az(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def _runs(items: Column, run) -> Column:
    """``run(i)`` for each start of 5 neighbours among ``items``, which must be a column, not an expression:
    what a lambda refers to is computed anew for each start."""
    return F.transform(F.sequence(F.lit(0), F.size(items) - WORDS), run)


def with_shingles(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``shingles``, the runs of 5 words as text; fewer words are one shingle, none give none."""
    words = df.select(*keep, words_of(F.col("text")).alias("w"))
    w = F.col("w")
    return words.select(*keep, F.when(F.size(w) >= WORDS, _runs(w, lambda i: F.array_join(F.slice(w, i + 1, F.lit(WORDS)), " ")))
                        .when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>")).alias("shingles"))


def with_hashes(df: DataFrame, *keep: str) -> DataFrame:
    """``keep``, ``nw`` (words) and ``keys``, the hash of each shingle, made from the hashes of its words."""
    h = F.col("h")
    words = df.select(*keep, F.transform(words_of(F.col("text")), lambda x: F.xxhash64(x)).alias("h"))
    return words.select(*keep, F.size(h).alias("nw"),
                        F.when(F.size(h) >= WORDS, _runs(h, lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(WORDS)))))
                        .when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")).alias("keys"))


# Arrays are opened with explode_outer: for a plain explode the planner would add a
# "not empty" filter and push it below the columns that the lambdas above refer to.
# Nulls that it makes of empty arrays match nothing in the joins that follow.


def needed(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def sketches(items: DataFrame, percent: int) -> DataFrame:
    """(item_id, n, least, size_class, key): the bottom-k hashes of each item's set.

    ``k`` is that of the upper end of the item's size class, which is at least
    its own; ``least`` is the size that a document must have.
    """
    key = (with_hashes(items, "item_id").select("item_id", F.array_distinct("keys").alias("keys"))
                .select("item_id", F.size("keys").alias("n"), F.array_sort("keys").alias("keys")).filter("n > 0"))
    size_class = F.floor(F.log2("n"))
    upper = F.pow(F.lit(2.0), size_class + 1) - 1
    k = F.least(F.col("n"), (upper - needed(upper, percent) + 1).cast("int"))
    return key.select("item_id", "n", needed(F.col("n"), percent).cast("int").alias("least"), size_class.alias("size_class"),
                      F.explode_outer(F.slice("keys", F.lit(1), k)).alias("key"))


def search(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, item_id, n_item, n_found): pairs in which the document holds at least
    ``percent`` of the item's distinct 5-word shingles.

    Both tables have an id (doc_id, item_id) and text.  Words are split at ASCII
    white space, A-Z lowered; a text of fewer than 5 words is one shingle.  Null
    and empty items match nothing, null and empty documents hold nothing, rows
    with a null id are left out.  Rows that repeat an id count as one document
    (or item) that holds the shingles of all.  Other columns are left out.
    """
    items = items.filter("item_id is not null").select("item_id", "text")
    docs = docs.filter("doc_id is not null").select("doc_id", "text")
    sketch = stage(sketches(items, percent), "decontaminate-sketches")
    shortest = sketch.agg(F.min("least")).first()[0]
    if shortest is None:
        shortest = 0
    # a row of an id that repeats may hold a part only of what its document holds: sizes say nothing there
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id", F.lit(True).alias("again"))
    rows = docs.join(sized(stage(again, "decontaminate-again"), 64), "doc_id", "left")
    keys = with_hashes(rows, "doc_id", "again").filter((F.col("nw") >= (shortest if shortest <= 1 else shortest + WORDS - 1)) | F.col("again"))
    probes = keys.select("doc_id", "nw", "again", F.explode_outer("keys").alias("key"))
    # a document's distinct shingles are at most its words
    near = (probes.join(sized(sketch.select("item_id", "least", "key"), 64), "key").filter("nw >= least or again")
                  .select("doc_id", "item_id").distinct())
    near = stage(near, "decontaminate-near")

    item_sets = with_shingles(items, "item_id").select("item_id", F.explode_outer("shingles").alias("shingle")).filter("shingle is not null").distinct()
    sizes = item_sets.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    wanted = stage(near.groupBy("doc_id").agg(F.collect_set("item_id").alias("items")), "decontaminate-docs")
    held = docs.join(sized_lists(wanted, "items", 16), "doc_id")
    held = with_shingles(held, "doc_id").select("doc_id", F.explode_outer("shingles").alias("shingle"))
    item_sets = stage(item_sets, "decontaminate-items")
    found = (held.join(sized(item_sets, 256), "shingle").select("doc_id", "item_id", "shingle").distinct()
                 .groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_found")))
    return (found.join(near, ["doc_id", "item_id"], "left_semi").join(sized(stage(sizes, "decontaminate-sizes"), 32), "item_id")
                 .filter(F.col("n_found") >= needed(F.col("n_item"), percent))
                 .select("doc_id", "item_id", "n_item", "n_found"))


def clean(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """``docs``, every column, without the documents that hold a test item; a null doc_id stays."""
    hit = stage(search(docs, items, percent).select("doc_id").distinct(), "decontaminate-hits")
    return docs.join(sized(hit, 16), "doc_id", "left_anti").select(*docs.columns)


#: The same search in SQL, by brute force: every shingle of every document against every item.
SQL = r"""
WITH w AS (
  SELECT 0 AS side, doc_id AS id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT 1, item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')
  FROM benchmark WHERE item_id IS NOT NULL
), s AS (
  SELECT DISTINCT side, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
         lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT id AS item_id, count(*) AS n_item FROM s WHERE side = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n_item) AS n_item, count(*) AS n_found
FROM s d JOIN s b ON b.side = 1 AND d.side = 0 AND d.shingle = b.shingle JOIN n ON n.item_id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 75 * any_value(n_item)
"""
