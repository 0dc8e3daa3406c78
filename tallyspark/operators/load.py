"""J1, J2 and the month-table writes (S8-S10): incremental, idempotent loads.

Rows are routed by the month of their own date (T13).  For every month in
the batch the existing keys of that month are anti-joined away (J1); a month
with no table yet simply receives every row (its anti join is against
nothing).  All months are written by one partitioned append, so a run
publishes all its months through one commit.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.keys import DIGEST
from ..plans.joins import STORED_AS, flag_hashes, materialize, size_checked
from ..sources import paths
from ..sources.paths import exists
from .keys import row_digest_of, with_digest
from .parse import month_of

MONTH = "month"


def with_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumn(MONTH, month_of(F.col(date_col)))


def by_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    """``df`` with the rows of a month together, in as many parts as the month needs.

    For rows that are still narrow: what is derived from them and staged in that order needs no shuffle when
    it is written by month.  A date that a later step shifts only puts its row into one more file.
    """
    return df.withColumn("__month", month_of(F.col(date_col))).hint("rebalance", "__month").drop("__month")


def anti_join(new: DataFrame, existing: DataFrame, key: str = "uuid") -> DataFrame:
    """Rows of ``new`` whose (month, key) is not in ``existing``.

    Duplicates inside ``new`` are kept.  The key is a prefix of a digest; two rows
    are the same only if the whole digest agrees, so a collision drops no row.
    Month tables store the digest, so their side reads that column (32 bytes a
    row) and no text; Catalyst/AQE choose broadcast or shuffle from its measured
    size, and the digest spreads any one month over all tasks.
    """
    old = existing.select(MONTH, row_digest_of(existing, key).alias("__digest"))
    return (new.withColumn("__digest", row_digest_of(new, key))
               .join(old, [MONTH, "__digest"], "left_anti").select(*new.columns))


def unseen(new: DataFrame, existing: DataFrame, key: str = "uuid", grouped: bool = False) -> DataFrame:
    """``anti_join`` that moves whole rows only where it must.

    First the 64-bit hashes of both sides' keys meet, 8 bytes a row.  Without a common one no
    row is known; with few, whole digests of those alone are compared, in a broadcast.  With many, rows without a
    common hash stay where they are, and of the others the digests are compared: mostly all of these are known, or all but a
    few that a broadcast names.  Else the rows that may be unknown go through the join as a whole; where the
    rows of ``new`` are ``grouped`` by month, these are grouped again.
    """
    hashed = lambda df: F.xxhash64(MONTH, row_digest_of(df, key))
    one = lambda df: df.select(hashed(df).alias("__hash"))
    common = materialize(one(new).join(one(existing), "__hash", "left_semi").distinct(), "known-keys")
    if common.isEmpty():
        return new
    digests = lambda df: df.select(MONTH, row_digest_of(df, key).alias("__digest"))
    with_its = new.withColumn("__digest", row_digest_of(new, key))
    few = size_checked(common, 256)
    if few is not common:
        old = existing.select(MONTH, row_digest_of(existing, key).alias("__digest"), hashed(existing).alias("__hash"))
        old = old.join(few, "__hash", "left_semi")
        old = size_checked(materialize(old.select(MONTH, "__digest").distinct(), "known"), 256)
        return with_its.join(old, [MONTH, "__digest"], "left_anti").select(*new.columns)
    flagged = flag_hashes(new, hashed(new), common, "__maybe")
    maybe = new if flagged is None else flagged.filter("__maybe").select(*new.columns)
    fresh = materialize(digests(maybe).join(digests(existing), [MONTH, "__digest"], "left_anti").distinct(), "not-known")
    named = size_checked(fresh, 256)
    if named is not fresh:
        left = maybe.withColumn("__digest", row_digest_of(maybe, key)).join(named, [MONTH, "__digest"], "left_semi").select(*new.columns)
    else:
        again = flag_hashes(maybe, hashed(maybe), fresh.select(F.xxhash64(MONTH, "__digest")), "__maybe")
        left = anti_join(maybe if again is None else again.filter("__maybe").select(*new.columns), existing, key)
        left = left.hint("rebalance", MONTH) if grouped else left
    return left if flagged is None else flagged.filter("not __maybe").select(*new.columns).unionByName(left)


def batch_months(batch: DataFrame) -> list[str]:
    """Distinct months of the batch, ascending (bounded: one per calendar month)."""
    return [r[0] for r in batch.select(MONTH).distinct().orderBy(MONTH).collect()]


def read_existing(batch: DataFrame, base_path: str, months: list[str]) -> DataFrame | None:
    """The month tables the batch touches (partition pruning on ``month``)."""
    spark = batch.sparkSession
    recover_months(spark, base_path)
    if not months or not exists(spark, base_path):
        return None
    return spark.read.parquet(base_path).filter(F.col(MONTH).isin(months))


@dataclass
class LoadResult:
    months: list[str]
    incoming: int
    delta: int
    incoming_by_month: dict[str, int] | None = None


def route(batch: DataFrame, base_path: str, key: str = "uuid", counts: DataFrame | None = None, grouped: bool = False) -> LoadResult:
    """J2 + S8-S10: append the new rows of every month of ``batch``.

    ``batch`` is read twice, for its months and for its rows; ``counts`` may give the
    same rows by month from a table that is cheaper to read.  A second identical
    run appends nothing.  Rows are stored with their digest; a table that was
    written without keeps its columns, and its digests are computed as it is read.
    Rows that are ``grouped`` by month already (``by_month``) are written without another shuffle.
    """
    if MONTH not in batch.columns:
        batch = with_month(batch)
    # one small job: months of the batch with their row counts (bounded by calendar months)
    per_month = {r[MONTH]: int(r["n"]) for r in
                 (batch if counts is None else counts).groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).collect()}
    months = sorted(per_month)
    incoming = sum(per_month.values())
    if incoming == 0:                       # nothing arrived: touch no table
        return LoadResult(months=[], incoming=0, delta=0, incoming_by_month={})
    existing = read_existing(batch, base_path, months)
    if existing is None or DIGEST in existing.columns:
        batch = with_digest(batch)
    delta = batch if existing is None else unseen(batch, existing, key, grouped)
    if existing is not None and DIGEST not in existing.columns:
        delta = delta.drop(DIGEST)
    # rebalance by month: AQE packs small months into few files and splits a
    # hot month over several tasks, instead of every task writing every month
    obs = Observation("load")
    delta = (delta if grouped else delta.hint("rebalance", MONTH)).observe(obs, F.count(F.lit(1)).alias("delta"))
    delta.write.mode("append").option("compression", STORED_AS).partitionBy(MONTH).parquet(base_path)
    n_delta = int(obs.get.get("delta", 0)) if obs.get else 0
    return LoadResult(months=months, incoming=incoming, delta=n_delta, incoming_by_month=per_month)


#: Folders beside the months; Spark's sources do not look into names with an underscore.
_NEW, _OLD = "_compacted-", "_replaced-"


def set_aside(spark: SparkSession, base_path: str) -> list[str]:
    """Months that a compaction has moved away and not put back yet."""
    there = paths.names(spark, base_path)
    return [m for n in there if n.startswith(_OLD) for m in paths.names(spark, f"{base_path}/{n}") if m not in there]


def recover_months(spark: SparkSession, base_path: str) -> None:
    """End what a compaction left undone: a month that was set aside gets its new files, or else its old ones back.

    Writers of month tables call this first; there is one at a time.  Readers refuse
    a table of which a month is set aside (``set_aside``).
    """
    if not exists(spark, base_path):
        return
    left = [n for n in paths.names(spark, base_path) if n.startswith((_NEW, _OLD))]
    for old in (n for n in left if n.startswith(_OLD)):
        new = f"{base_path}/{_NEW}{old.removeprefix(_OLD)}"
        for month in paths.names(spark, f"{base_path}/{old}"):
            if not exists(spark, f"{base_path}/{month}"):
                ready = f"{new}/{month}"
                paths.rename(spark, ready if exists(spark, ready) else f"{base_path}/{old}/{month}", f"{base_path}/{month}")
    for n in left:
        paths.delete(spark, f"{base_path}/{n}")


def compact(spark: SparkSession, base_path: str, max_files: int, target_bytes: int = 128 << 20) -> list[str]:
    """Write months anew that many appends have left in more than ``max_files`` files, small ones on average.

    All of them go through one job into a folder beside the months, in files of about
    ``target_bytes``, and no row through a shuffle.  Then month by month the old folder is set aside and the new
    one takes its name; ``recover_months`` ends a swap that a lost run began.  One
    writer at a time, as for the appends.  Returns the months.
    """
    recover_months(spark, base_path)
    if not exists(spark, base_path):
        return []
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(base_path)
    found = files.groupBy(F.col(MONTH).cast("string").alias(MONTH)).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).collect()
    want = {r[MONTH]: -(-r["bytes"] // target_bytes) for r in found if r["n"] > max(max_files, 2 * -(-r["bytes"] // target_bytes))}
    if not want:
        return []
    run = uuid.uuid4().hex[:12]
    # the files of a month are read one after the other by as many tasks as it gets files: no row is shuffled
    schema = spark.read.parquet(base_path).schema
    reader = spark.read.schema(schema).option("basePath", base_path)
    rows = [reader.parquet(f"{base_path}/{MONTH}={m}").coalesce(n) for m, n in sorted(want.items())]
    # no row, in two partitions: a union of single partitions alone is one partition, which one task would write
    rows.append(spark.range(0, 0, 1, 2).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows[0].schema]))
    reduce(DataFrame.unionByName, rows).write.option("compression", STORED_AS).partitionBy(MONTH).parquet(f"{base_path}/{_NEW}{run}")
    for month in sorted(want):
        name = f"{MONTH}={month}"
        paths.rename(spark, f"{base_path}/{name}", f"{base_path}/{_OLD}{run}/{name}")
        paths.rename(spark, f"{base_path}/{_NEW}{run}/{name}", f"{base_path}/{name}")
    recover_months(spark, base_path)
    return sorted(want)


def write_fresh(df: DataFrame, base_path: str, grouped: bool = False) -> None:
    """Replace exactly the months present in ``df`` (dynamic partition overwrite); ``grouped`` as for ``route``."""
    if MONTH not in df.columns:
        df = with_month(df)
    df = with_digest(df)
    recover_months(df.sparkSession, base_path)
    ((df if grouped else df.hint("rebalance", MONTH)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", STORED_AS).partitionBy(MONTH).parquet(base_path))


def month_counts(batch: DataFrame, existing: DataFrame | None, delta: DataFrame) -> DataFrame:
    """Incoming / existing / delta rows per month."""
    inc = batch.groupBy(MONTH).agg(F.count(F.lit(1)).alias("incoming"))
    dl = delta.groupBy(MONTH).agg(F.count(F.lit(1)).alias("delta"))
    out = inc.join(dl, MONTH, "left")
    if existing is not None:
        ex = existing.groupBy(MONTH).agg(F.count(F.lit(1)).alias("existing"))
        out = out.join(ex, MONTH, "left")
    else:
        out = out.withColumn("existing", F.lit(0).cast("bigint"))
    return out.select(MONTH, "incoming", F.coalesce("existing", F.lit(0)).cast("bigint").alias("existing"),
                      F.coalesce("delta", F.lit(0)).cast("bigint").alias("delta"))
