"""Parse `particulars`, standardise the raw category, salary shift.

All bank-specific rules are written as ``when(bank == ...)`` branches of one
projection, so a batch holding several banks is transformed in a single pass
(T14) instead of one pass per bank.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings
from ..functions.literals import string_map
from ..functions.text import WHITE_SPACE, capitalize, is_blank, py_strip


def _char_class(chars: str) -> str:
    return "[" + "".join(re.escape(c) if c in "\\]^-[" else c for c in chars) + "]"


def _plain_char(c: str) -> str:
    """A pattern for one character that ``String.split`` cuts at without compiling it."""
    return c if c not in ".$|()[{^?*+\\" else "\\" + c


def split_tokens(particulars: Column, bank: Column, settings: Settings) -> Column:
    """T1 + T2: split on the bank's character class, drop blank tokens (kept unstripped)."""
    expr = None
    for b in settings.banks:
        # every separator becomes the first one: a split on one plain character, not in a class, compiles no pattern a row
        first, *rest = b.split_class
        text = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(first)), rest, particulars)
        arr = F.split(text, _plain_char(first))
        # a token of white space needs a separator, or the start, before its first character
        spaced = text.rlike(f"(?:^|{_char_class(first)})[{WHITE_SPACE}]")
        arr = F.when(spaced, F.filter(arr, lambda t: ~is_blank(t))).otherwise(F.array_remove(arr, ""))
        expr = F.when(bank == b.bank, arr) if expr is None else expr.when(bank == b.bank, arr)
    return expr


def is_manual(cr: Column, bank: Column, len_split: Column) -> Column:
    """T4."""
    return (F.when(cr.isNotNull(), "Y")
             .when(bank == "hdfc", "Y")
             .when((bank == "axis") & len_split.isin(1, 5), "Y")
             .otherwise("N"))


def positional_fields(split: Column, n: Column, bank: Column) -> dict[str, Column]:
    """T5: (transaction_type, transaction_no, payment_to, raw_category) by token position."""
    g = lambda i: F.get(split, i)  # null when out of range
    axis = bank == "axis"
    hdfc = bank == "hdfc"
    ax_ok = axis & n.isin(5, 6, 7)
    return {
        "transaction_type": F.when(ax_ok | hdfc, g(0)),
        "transaction_no": F.when(axis & n.isin(6, 7), g(2)).when(hdfc & (n == 5), g(3)),
        "payment_to": F.when(axis & n.isin(6, 7), g(3)),
        "raw_category": (F.when(axis & n.isin(5, 6), g(4)).when(axis & (n == 7), g(5))
                          .when(hdfc & (n == 5), g(4))),
    }


def data_preprocessor(df: DataFrame, settings: Settings) -> DataFrame:
    """T1-T5."""
    df = df.withColumn("split", split_tokens(F.col("particulars"), F.col("bank"), settings))
    df = df.withColumn("len_split", F.size("split"))
    df = df.withColumn("is_manual", is_manual(F.col("cr"), F.col("bank"), F.col("len_split")))
    return df.withColumns(positional_fields(F.col("split"), F.col("len_split"), F.col("bank")))


def value_map(settings: Settings) -> Column:
    return string_map((raw.lower() if settings.normalize_map_keys else raw, std)
                      for raw, std in settings.value_map)


def clean_raw_category(df: DataFrame, settings: Settings, col: str = "raw_category") -> DataFrame:
    """T6 (whole-value map after lower-casing, not chained) + T7 (null -> 'unspecified')."""
    v = F.lower(F.col(col))
    mapped = F.coalesce(F.try_element_at(value_map(settings), v), v)
    return df.withColumn(col, F.coalesce(mapped, F.lit(settings.null_category)))


def apply_raw_category_transformation(df: DataFrame, settings: Settings) -> DataFrame:
    """T8 (strip + lower, null payee -> 'none') + T9 (generic categories take the payee)."""
    raw = F.lower(py_strip(F.col("raw_category")))
    payee = F.coalesce(F.lower(py_strip(F.col("payment_to"))), F.lit(settings.null_payee))
    df = df.withColumn("payment_to", payee)
    return df.withColumn("raw_category", F.when(raw.isin(*settings.generic_categories), F.col("payment_to"))
                                          .otherwise(raw))


def capitalize_raw_category(df: DataFrame, col: str = "raw_category") -> DataFrame:
    """T10."""
    return df.withColumn(col, capitalize(F.col(col)))


def modify_salaried_record(df: DataFrame, settings: Settings) -> DataFrame:
    """Salary rows move to the 1st of the next month and become 'Salary'."""
    hit = F.coalesce(F.col("raw_category").contains(settings.salary_account), F.lit(False))
    return df.withColumns({
        "date": F.when(hit, F.add_months(F.trunc("date", "MM"), 1)).otherwise(F.col("date")),
        "raw_category": F.when(hit, F.lit(settings.salary_label)).otherwise(F.col("raw_category")),
    })


def month_of(c: Column) -> Column:
    """Month taken from the data's own date."""
    return F.date_format(c, "yyyy-MM")
