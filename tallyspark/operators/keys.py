"""K1, K2 and the documented transaction-id key (D-K)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, TimestampType

from ..config import KEY_COLUMNS, Settings
from ..functions.keys import DIGEST, digest_bytes, key_of, row_key, txn_key

_WANTED = {"date": "date", "particulars": "string", "dr": "decimal", "cr": "decimal"}
_KINDS = {DateType: "date", TimestampType: "date", StringType: "string", DecimalType: "decimal"}


def key_parts(df: DataFrame, columns: tuple[str, ...]) -> list[tuple[Column, str]]:
    """K2: the key columns with their kinds; a schema that cannot give stable keys is refused.

    Keys are made of dates, text and decimals of 2 places at most; binary floating
    point and integers have other texts for the same amount.
    """
    faults, parts = [], []
    for c in columns:
        kind = next((f.dataType for f in df.schema if f.name == c), None)
        name = _KINDS.get(type(kind))
        if name is None or name != _WANTED.get(c, name) or (name == "decimal" and kind.scale > 2):
            faults.append(f"{c}: {'absent' if kind is None else kind.simpleString()}")
        parts.append((F.col(c), "day" if isinstance(kind, DateType) else name or ""))
    if faults:
        raise ValueError("no row key can be built from " + ", ".join(faults))
    return parts


def build_unique_key(df: DataFrame, settings: Settings, unique_key: str = "uuid") -> DataFrame:
    """K1 with the K2 check (driver side, on the schema only); taken from the stored digest where there is one."""
    if DIGEST in df.columns:
        return df.withColumn(unique_key, key_of(F.col(DIGEST)))
    return df.withColumn(unique_key, row_key(key_parts(df, settings.key_columns)))


def with_digest(df: DataFrame, columns: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    """``df`` with the digest of its key columns (K2-checked) stored as a column, unless it has one or lacks them."""
    if DIGEST in df.columns or not set(columns) <= set(df.columns):
        return df
    return df.withColumn(DIGEST, digest_bytes(key_parts(df, columns)))


def row_digest_of(df: DataFrame, key: str, columns: tuple[str, ...] = KEY_COLUMNS) -> Column:
    """The whole digest behind the 16-character key, for comparisons.

    The stored one where the table holds it; computed for tables written without;
    the key itself where its columns are absent.
    """
    if DIGEST in df.columns:
        return F.col(DIGEST)
    if set(columns) <= set(df.columns):
        return digest_bytes(key_parts(df, columns))
    return F.col(key)


def build_txn_key(df: DataFrame, settings: Settings, unique_key: str = "uuid",
                  txn_col: str = "transaction_no") -> DataFrame:
    """D-K: transaction id when >= min length and not a stop word, else the K1 hash."""
    return df.withColumn(unique_key, txn_key(F.col(txn_col), row_key(key_parts(df, settings.key_columns)),
                                             settings.min_txn_id_len, settings.invalid_txn_ids))
