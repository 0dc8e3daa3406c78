"""Scalar string, number and date expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Python's str.strip() removes any Unicode whitespace; Spark's trim() only spaces, unless it is given the characters.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
# The plain forms that nearly all cells have; they need one regular expression and a cast.
_PLAIN_NUMBER = r"^\d{1,16}(?:\.\d{1,2})?\z"
_PLAIN_DATE = r"^\d{2}[/.-]\d{2}[/.-](?:[1-9]\d{3}|\d{2})\z"
# A plain number as pandas.to_numeric accepts it: no thousands separators,
# no unit suffixes.  Anything else is "not a number" and becomes null.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Day-first dates: d/M/yy, d-M-yyyy, d.M.yy ...
_DAY_FIRST = r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4}|\d{2})\s*$"
# A time of day after a date, as timestamps in exports carry it.
_TIME = r"[ T]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*$"
# Month names: 01-Apr-2026, 1 April 26.
_MONTH_NAME = r"^\s*(\d{1,2})[ /.-]*([A-Za-z]{3})[A-Za-z]*[ /.,-]*(\d{4}|\d{2})\s*$"
# Two-digit years below the pivot are 20yy, the rest 19yy (POSIX %y rule).
YEAR_PIVOT = 69


def py_strip(c: Column) -> Column:
    """``str.strip``; a text that begins and ends with a visible ASCII character is not searched for white space."""
    visible = lambda x: x.between("!", "~")  # noqa: E731  any other first byte sorts outside, as does an empty text
    return F.when(visible(F.substring(c, 1, 1)) & visible(F.substring(c, -1, 1)), c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def is_blank(c: Column) -> Column:
    """Nothing but what ``py_strip`` removes; decided at the first other character."""
    return c.rlike(f"^[{WHITE_SPACE}]*+\\z")


def norm(c: Column, case_sensitive: bool = False) -> Column:
    s = py_strip(c)
    return s if case_sensitive else F.lower(s)


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower (str.capitalize, not initcap)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def amount(c: Column, dtype: str = "decimal(18,2)") -> Column:
    """Text amount -> decimal; '1,234.50', '12d', 'abc' -> null, as is a value that ``dtype`` cannot hold exactly."""
    exact = F.trim(c).try_cast(dtype)
    plain = F.when(c.rlike(_PLAIN_NUMBER), c.try_cast(dtype)) if dtype == "decimal(18,2)" else F
    return plain.when(c.rlike(_NUMBER) & (exact == F.trim(c).try_cast("decimal(38,18)")), exact)


def bad_amount(c: Column, value: Column | None = None) -> Column:
    """True when a non-blank amount cell gives no amount; ``value`` is the cell's amount where that is known."""
    value = amount(c) if value is None else value
    return value.isNull() & F.coalesce(py_strip(c) != "", F.lit(False))


def day_first_date(c: Column) -> Column:
    """Day-first text date -> DateType; impossible dates (31/02) -> null.

    d/M/yy, d-M-yyyy, d.M.yy, d-MMM-yyyy, d MMMM yy ... are rewritten to y-M-d
    (ISO text passes through unchanged) and parsed strictly; a time of day is
    dropped.
    """
    short = F.length(c) < 10
    year = F.when(~short, F.substring(c, 7, 4)).otherwise(F.concat(_century(F.substring(c, 7, 2)), F.substring(c, 7, 2)))
    plain = F.concat_ws("-", year, F.substring(c, 4, 2), F.substring(c, 1, 2)).try_cast("date")
    return F.when(c.rlike(_PLAIN_DATE), plain).otherwise(_any_day_first_date(c))


def _century(two_digits: Column) -> Column:
    return F.when(two_digits < F.lit(f"{YEAR_PIVOT:02d}"), F.lit("20")).otherwise(F.lit("19"))


def _let(c: Column, use) -> Column:
    """``use(c)`` with ``c`` computed once: written out at every use, the code of a step gets too long to be compiled."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _any_day_first_date(c: Column) -> Column:
    def ymd(day):
        named = F.concat(F.regexp_extract(day, _MONTH_NAME, 3), F.lit("-"),
                         F.initcap(F.regexp_extract(day, _MONTH_NAME, 2)), F.lit("-"), F.regexp_extract(day, _MONTH_NAME, 1))
        return F.when(day.rlike(_MONTH_NAME), named).otherwise(F.regexp_replace(day, _DAY_FIRST, "$3-$2-$1"))

    def full(t):
        return F.when(t.rlike(r"^\d{2}-"), F.concat(_century(F.substring(t, 1, 2)), t)).otherwise(F.trim(t))

    def parsed(t):      # a text that fails costs the parser an exception, so only those of its form are given to it
        return (F.when(t.rlike(r"^[+-]?\d+-[+-]?\d+-[+-]?\d+\z"), F.try_to_date(t, "y-M-d"))
                 .when(t.rlike(r"^[+-]?\d+-[^-]+-[+-]?\d+\z"), F.try_to_date(t, "y-MMM-d")))

    return _let(_let(_let(F.regexp_replace(c, _TIME, ""), ymd), full), parsed)


def safe_contains(c: Column, needle: str) -> Column:
    """Null-safe contains: null text never matches."""
    return F.coalesce(c.contains(needle), F.lit(False))
