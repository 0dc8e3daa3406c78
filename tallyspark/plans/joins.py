"""Join helpers that never broadcast a side whose size grows unchecked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path


#: Codec of the tables that jobs write; a session's default, snappy, takes a third more room.
STORED_AS = "zstd"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` as parquet under the shared checkpoint folder, read it back.

    The folder comes from ``spark.checkpoint.dir`` (shared storage on a
    cluster), so the table survives executor loss and later jobs never
    recompute its lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", STORED_AS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)       # known: no job that asks the files


#: Bytes of counted rows up to which a side is broadcast.
BROADCAST_BYTES = 32 << 20


def size_checked(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (already materialised) with a broadcast hint when its counted rows fit, else unchanged."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


#: A bitmap of hashes has at most 2 to this power bits (32 MB), whatever the number of rows.
BITMAP_POWER = 28


def flag_hashes(df: DataFrame, hashed: Column, hashes: DataFrame, flag: str) -> DataFrame | None:
    """``df`` with ``flag``, false only where ``hashed`` is surely none of ``hashes`` (one column, already written).

    The hashes are marked in a bitmap, 16 bits each as long as it does not grow beyond its bound, which is
    broadcast in pieces of 4 KB: a row meets one bit, and none is shuffled.  None where they are so
    many that the bitmap would tell few rows apart.
    """
    n = hashes.count()
    if 2 * n > 1 << BITMAP_POWER:
        return None
    cells = 1 << min(BITMAP_POWER, max(15, (16 * n).bit_length()))
    cell = F.pmod(F.col("__hashed"), F.lit(cells).cast("bigint"))
    maps = hashes.toDF("__hashed").groupBy(F.bitmap_bucket_number(cell).alias("__piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("__bits"))
    at = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (df.withColumn("__hashed", hashed)
              .join(F.broadcast(maps), F.bitmap_bucket_number(cell) == F.col("__piece"), "left")
              .withColumn(flag, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
              .drop("__hashed", "__piece", "__bits"))


def text_bytes(*columns: Column) -> Column:
    """Bytes of a row that holds these texts, with what a hash table adds to it."""
    return F.lit(64) + sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))


def lookup_join(big: DataFrame, key: Column, lookup: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Left join of ``lookup`` (texts ``__v``, ``__label``, and ``n``, the rows of ``big`` that hold the value) onto ``big``.

    ``lookup`` holds every value of ``key`` once and grows with the data.  It is
    written to the shared checkpoint folder and its bytes are summed: up to
    ``max_bytes`` it is broadcast.  Beyond, the join is a shuffle on the value and
    a salt: a value is dealt over one part for each 64th of a task's share of
    all rows that it holds, and its lookup row is sent to every part.  The list of
    such values has at most 64 rows a partition; it is broadcast, in longer shares
    if its texts exceed the bound.  Adds ``__label``.
    """
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    lookup = materialize(lookup, "lookup")
    size, rows = lookup.agg(F.sum(text_bytes(F.col("__v"), F.col("__label"))), F.sum("n")).first()
    if (size or 0) <= limit:
        return big.join(F.broadcast(lookup.drop("n")), key.eqNullSafe(F.col("__v")), "left").drop("__v")
    tasks = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, rows // (64 * tasks))
    while True:
        parts = F.ceil(F.col("n") / F.lit(share))
        hot = lookup.filter(F.col("n") > share).select(F.col("__v").alias("__hot"), parts.alias("__parts"))
        if (hot.agg(F.sum(text_bytes(F.col("__hot")))).first()[0] or 0) <= max(limit, 1 << 20):
            break
        share *= 4
    salted = lookup.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("n")
    dealt = (big.withColumn("__at", F.monotonically_increasing_id())
                .join(F.broadcast(hot), key.eqNullSafe(F.col("__hot")), "left")
                .withColumn("__deal", F.pmod("__at", F.coalesce("__parts", F.lit(1)))))
    same = key.eqNullSafe(F.col("__v")) & (F.col("__deal") == F.col("__part"))
    return dealt.join(salted, same, "left").drop("__v", "__at", "__hot", "__parts", "__deal", "__part")
