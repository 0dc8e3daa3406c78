"""Cleaned statement rows -> transformed rows (one projection chain)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Settings
from ..functions.keys import DIGEST
from ..operators import category, keys, parse

TRANSFORMED_COLUMNS = [
    "date", "particulars", "dr", "cr", "bank", "split", "len_split", "is_manual",
    "transaction_type", "transaction_no", "payment_to", "raw_category",
    "SubCategory", "Category", "uuid",
]


def prepare(df: DataFrame, settings: Settings) -> DataFrame:
    """The row-wise steps before the category: T1-T11, salary shift included."""
    df = parse.data_preprocessor(df, settings)                    # T1-T5
    df = parse.clean_raw_category(df, settings)                   # T6, T7
    df = parse.apply_raw_category_transformation(df, settings)    # T8, T9
    df = parse.capitalize_raw_category(df)                        # T10
    return parse.modify_salaried_record(df, settings)             # T11


def finish(df: DataFrame, settings: Settings, distinct_categories: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Category and key of prepared rows; a stored digest among them is kept."""
    df = category.build_category_pipeline(df, settings, distinct=distinct_categories)  # C1-C11
    df = keys.build_unique_key(df, settings)                      # K1, K2
    stored = [DIGEST] if DIGEST in df.columns else []
    return df.select(*TRANSFORMED_COLUMNS, *keep, *stored)


def transform(df: DataFrame, settings: Settings, distinct_categories: bool = True,
              keep: tuple[str, ...] = (), stage=None, digest: bool = False) -> DataFrame:
    """Order is semantic: the salary shift precedes the key, the map precedes the trim.

    ``keep`` names extra input columns passed through unchanged (lineage).
    ``stage`` (optional, DataFrame -> DataFrame) is applied to the rows before
    the category step, e.g. to write them once: that step reads its input
    twice (distinct values, then the join back).  With ``digest`` the rows carry
    the whole digest behind the key, computed once and staged with them.
    """
    df = prepare(df, settings)
    if digest:
        df = keys.with_digest(df, settings.key_columns)
    if stage is not None:
        df = stage(df)
    return finish(df, settings, distinct_categories, keep)
