"""Statement lines -> cleaned, typed rows plus a reject table.

Input: one row per data line, ``file_name, line_no, line``, carrying the
layout of its file's header (``header_layout``, computed once per file by
the reader).  Every line leaves as exactly one of a cleaned row or a reject
with a reason, so ``clean + rejects = input``.  No join or shuffle: the stage
is a chain of projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings
from ..functions.text import amount, bad_amount, day_first_date, py_strip, safe_contains

CLEAN_COLUMNS = ["date", "particulars", "dr", "cr", "bank"]
REJECT_COLUMNS = ["file", "line_no", "raw", "reason"]

# One cell after its comma: quoted (doubled quotes inside), or anything up to the next comma.
_CELL = r',("[^"]*+(?:""[^"]*+)*+"[^,]*|[^,]*)'


def csv_cells(line: Column) -> Column:
    """CSV text -> array of its cells, however many; empty cells are null, doubled quotes one quote."""
    def value(cell):
        inner = F.replace(F.regexp_replace(cell, r'(?s)^"(.*)"[^"]*$', "$1"), F.lit('""'), F.lit('"'))
        return F.when(cell.startswith('"') & (F.length(cell) > 1), inner).when(cell != "", cell)
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1)), value)


def unify_headers(header_cells: Column, settings: Settings) -> Column:
    """P3 + P4: lower/strip each name, then the first substring rule that hits renames it."""
    def rename(h):
        n = F.lower(py_strip(h))
        out = None
        for needle, target in settings.header_rules:
            cond = F.coalesce(n.contains(needle), F.lit(False))
            out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
        return out.otherwise(n)
    return F.transform(header_cells, rename)


def bank_tag(file_name: Column) -> Column:
    """P10: lower-cased file-name part before the first '_'."""
    return F.lower(F.substring_index(file_name, "_", 1))


def bank_profile(file_name: Column, settings: Settings) -> Column:
    """First configured bank whose name occurs in the lower-cased file name."""
    low = F.lower(file_name)
    out = None
    for b in settings.banks:
        cond = low.contains(b.bank)
        out = F.when(cond, F.lit(b.bank)) if out is None else out.when(cond, F.lit(b.bank))
    return out


def header_layout(df: DataFrame, settings: Settings, header_col: str = "header") -> DataFrame:
    """Interpret a header line once (per file, or per distinct layout).

    Adds ``width`` (number of header cells), the 0-based positions of the
    unified date / particulars / dr / cr columns, and ``header_ok`` (each of
    the four present exactly once; several ``date`` columns is an error).
    """
    df = df.withColumn("__h", csv_cells(F.col(header_col)))
    hcells = F.col("__h")
    df = df.withColumns({"__names": unify_headers(hcells, settings), "width": F.size(hcells)})

    def pos(name: str) -> Column:
        return F.array_position(F.col("__names"), name).cast("int") - 1

    def count_of(name: str) -> Column:
        return F.size(F.filter(F.col("__names"), lambda n: n == name))

    ok = None
    for name in ("date", "particulars", "dr", "cr"):
        c = count_of(name) == 1
        ok = c if ok is None else ok & c
    return df.withColumns({
        "i_date": pos("date"), "i_part": pos("particulars"), "i_dr": pos("dr"), "i_cr": pos("cr"),
        "header_ok": ok,
    }).drop("__h", "__names", header_col)


LAYOUT_COLUMNS = ["width", "i_date", "i_part", "i_dr", "i_cr", "header_ok"]


def parse_lines(lines: DataFrame, settings: Settings, keep: tuple[str, ...] = ()) -> DataFrame:
    """All P-steps as staged projections; adds ``reason`` (null for clean rows).

    Input columns: ``file_name, line_no, line`` plus the layout columns from
    ``header_layout``.  Each stage computes a value once and later stages
    refer to it by name, so the optimized plan stays linear in size and the
    per-line work is one CSV parse plus codegen'd scalar expressions.  ``keep``
    names further columns to pass through (the file's identity).
    """
    quoted = F.col("line").contains('"')       # only such a line needs more than a split at its commas
    df = lines.select(
        F.col("file_name"), F.col("line_no").cast("int").alias("line_no"), F.col("line"),
        *LAYOUT_COLUMNS, *keep, F.when(quoted, csv_cells(F.col("line"))).alias("cells"),
        F.when(~quoted, F.split(F.col("line"), ",")).alias("plain"))
    width, cells, plain = F.col("width"), F.col("cells"), F.col("plain")
    # a missing cell counts as null
    first = lambda a: F.slice(a, 1, F.greatest(width, F.lit(0)))
    nulls = width - (F.when(cells.isNotNull(), F.size(F.filter(first(cells), lambda c: c.isNotNull())))
                      .otherwise(F.size(F.array_remove(first(plain), ""))))
    cell = lambda i: F.coalesce(F.get(cells, F.col(i)), F.nullif(F.get(plain, F.col(i)), F.lit("")))
    df = df.select(
        "file_name", "line_no", "line", "width", "header_ok", *keep, nulls.alias("nulls"),
        cell("i_date").alias("d_txt"), cell("i_part").alias("p_txt"), cell("i_dr").alias("dr_txt"), cell("i_cr").alias("cr_txt"))
    d_txt, p_txt, dr_txt, cr_txt = (F.col(c) for c in ("d_txt", "p_txt", "dr_txt", "cr_txt"))
    df = df.select(
        "*", day_first_date(d_txt).alias("date"),
        amount(dr_txt).alias("dr"), amount(cr_txt).alias("cr"),
        bank_tag(F.col("file_name")).alias("bank"),
        bank_profile(F.col("file_name"), settings).alias("profile"))
    nulls = F.col("nulls")
    reason = (F.when(nulls >= F.greatest(width, F.lit(1)), "all_null")            # P1
               .when(nulls > settings.null_threshold, "too_many_nulls")           # P2
               .when(~F.col("header_ok"), "bad_header")                           # P4 / trap 11
               .when(safe_contains(d_txt, "*"), "marker_row")                     # P5
               .when(safe_contains(d_txt, "Generated"), "footer_row")             # P6
               .when(d_txt.isNull(), "null_date")
               .when(F.col("date").isNull(), "bad_date")                          # P8
               .when(p_txt.isNull(), "null_particulars")
               .when(bad_amount(dr_txt, F.col("dr")) | bad_amount(cr_txt, F.col("cr")), "bad_amount")  # P7
               .when(F.col("profile").isNull() | (F.col("bank") != F.col("profile")),
                     "unknown_bank"))                                             # P10 / S4
    return df.select("file_name", "line_no", "line", "date", p_txt.alias("particulars"),
                     "dr", "cr", "bank", *keep, reason.alias("reason"))


def _keep(parsed: DataFrame, cond: Column, cols: list[Column]) -> DataFrame:
    """Rows where ``cond`` holds, written as a one-or-zero element explode.

    A Filter here would be pushed down through the parse projections and have
    every intermediate expression substituted into it; a generator keeps the
    parse computed once per line.
    """
    one = F.when(cond, F.array(F.struct(*cols)))       # null array -> null row
    return parsed.select(F.explode_outer(one).alias("r")).filter("r is not null").select("r.*")


def cleaned(parsed: DataFrame, lineage: bool = False) -> DataFrame:
    """Clean rows; ``lineage=True`` also keeps ``file_name, line_no``."""
    cols = CLEAN_COLUMNS + (["file_name", "line_no"] if lineage else [])
    return _keep(parsed, F.col("reason").isNull(), [F.col(c) for c in cols])


def rejects(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return _keep(parsed, F.col("reason").isNotNull(), [
        F.col("file_name").alias("file"), F.col("line_no"), F.col("line").alias("raw"), F.col("reason"),
        *[F.col(c) for c in keep]])
