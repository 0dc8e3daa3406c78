"""Scalar expressions: strip, capitalize, amounts, dates, keys, fuzzy score."""

import datetime as dt
import hashlib
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyspark.functions import fuzzy, keys, text


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("x")).first()["x"]


def test_py_strip_and_capitalize(spark):
    assert one(spark, text.py_strip(F.col("v")), "\t a b \n") == "a b"
    assert one(spark, text.capitalize(F.col("v")), "gROCERY store") == "Grocery store"
    assert one(spark, text.capitalize(F.col("v")), "") == ""


def test_amounts(spark):
    rows = [("150.00",), ("1,234.50",), ("12d",), ("abc",), (" 7.5 ",), (None,), ("",)]
    df = spark.createDataFrame(rows, "v string").select(text.amount(F.col("v")).alias("a"),
                                                        text.bad_amount(F.col("v")).alias("bad"))
    got = [(r.a, r.bad) for r in df.collect()]
    assert got == [(Decimal("150.00"), False), (None, True), (None, True), (None, True),
                   (Decimal("7.50"), False), (None, False), (None, False)]


def test_day_first_dates(spark):
    cases = {"01/04/26": dt.date(2026, 4, 1), "1-4-2026": dt.date(2026, 4, 1),
             "31/12/95": dt.date(1995, 12, 31), "31/02/26": None, "********": None,
             "Generated on 01/04/26": None, "2026-04-01": dt.date(2026, 4, 1), None: None}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select(
        "v", text.day_first_date(F.col("v")).alias("d"))
    assert {r.v: r.d for r in df.collect()} == cases


def _py_key(date, particulars, dr, cr):
    parts = [date, particulars, dr, cr]
    txt = "|".join("" if p is None else str(p).strip().lower() for p in parts)
    return hashlib.sha256(txt.encode()).hexdigest()[:16]


def test_row_key_matches_python_rendering(spark):
    rows = [(dt.date(2026, 4, 1), " UPI/1/Shop ", Decimal("150.00"), None),
            (dt.date(2026, 4, 2), "x", None, Decimal("12345678.90")),
            (dt.date(2026, 4, 3), None, Decimal("0.25"), Decimal("1.10"))]
    df = spark.createDataFrame(rows, "date date, particulars string, dr decimal(18,2), cr decimal(18,2)")
    k = keys.row_key([(F.col("date"), "date"), (F.col("particulars"), "string"),
                      (F.col("dr"), "decimal"), (F.col("cr"), "decimal")])
    got = [r.k for r in df.select(k.alias("k")).collect()]
    want = [_py_key("2026-04-01 00:00:00", " UPI/1/Shop ", 150.0, None),
            _py_key("2026-04-02 00:00:00", "x", None, 12345678.9),
            _py_key("2026-04-03 00:00:00", None, 0.25, 1.1)]
    assert got == want


def test_ratio_examples():
    assert round(fuzzy.token_sort_ratio_py("restuarant", "restaurants"), 1) == 85.7
    assert round(fuzzy.token_sort_ratio_py("other", "others"), 1) == 90.9
    assert round(fuzzy.token_sort_ratio_py("advance", "insurance"), 1) == 50.0


words = st.text(alphabet="abcdrst ", max_size=14)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(words, st.text(alphabet="abcdrst", min_size=1, max_size=12)),
                min_size=1, max_size=8))
def test_lcs_bits_and_dp_agree_with_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.collect()
    # bit-parallel needs per-label masks, built per pair here
    for r in rows:
        masks = fuzzy.masks_literal(r.b)
        full = F.lit((1 << len(r.b)) - 1).cast("bigint")
        got = df.filter((F.col("a") == r.a) & (F.col("b") == r.b)).select(
            fuzzy.lcs_bits(F.col("a"), masks, full, F.lit(len(r.b))).alias("bits"),
            fuzzy.lcs_dp(F.col("a"), F.col("b")).alias("dp")).first()
        want = fuzzy.lcs_py(r.a, r.b)
        assert got.bits == want and got.dp == want


def test_keys_stable_under_repartition(spark):
    from tallyspark.plans import catalog
    rows = catalog.transformed_rows(spark, "/root/testdata/sf0.001", lineage=True)
    a = rows.select("file_name", "line_no", "uuid")
    b = rows.repartition(7, "particulars").select("file_name", "line_no", "uuid")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_strip_removes_what_the_whitespace_class_of_unicode_holds(spark):
    c = F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')")
    t = spark.range(1, 0xffff).filter("id NOT BETWEEN 55296 AND 57343").select(c.alias("c")).select(F.concat("c", F.lit("a b"), "c").alias("v"))
    old = F.regexp_replace("v", r"(?U)^\s+|\s+$", "")
    assert t.filter(text.py_strip(F.col("v")) != old).count() == 0
    assert t.filter(text.is_blank(F.regexp_replace("v", "a b", "")) != (F.regexp_replace(F.regexp_replace("v", "a b", ""), r"(?U)\s", "") == "")).count() == 0


def test_plain_dates_and_amounts_give_what_the_general_path_gives(spark):
    days = ["01/02/24", "31/02/24", "29-02-2024", "29.02.2023", "00/01/20", "01/13/2020", "01/02/0000", "01/02/0099", "01/02/68", "01/02/69",
            "01/02/2024\n", " 01/02/2024", "1/2/24", "2024-02-01", "1 April 26", "01-Apr-2026", "********", "Generated on 1", "31-Feb-24",
            "01/02/2024 10:11", "", None]
    df = spark.createDataFrame([(d,) for d in days], "v string")
    got = df.select(text.day_first_date(F.col("v")).cast("string").alias("a"), text._any_day_first_date(F.col("v")).cast("string").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and sum(r.a is not None for r in got) >= 10
    sums = ["1", "1.5", "1.50", "1.505", "9" * 16, "9" * 17, "9" * 16 + ".99", "1.", ".5", " 2.50 ", "1e2", "-3.1", "1,0", "1d", "1.50\n", "", None]
    got = spark.createDataFrame([(d,) for d in sums], "v string").select(text.amount(F.col("v")).alias("a")).collect()
    assert [None if r.a is None else str(r.a) for r in got] == [
        "1.00", "1.50", "1.50", None, "9" * 16 + ".00", None, "9" * 16 + ".99", "1.00", "0.50", "2.50", "100.00", "-3.10", None, None, "1.50", None, None]


def test_a_date_is_written_out_once_in_a_plan(spark):
    df = spark.createDataFrame([("01/02/24",)], "v string").select(text.day_first_date(F.col("v")).alias("d"))
    assert str(df._jdf.queryExecution().optimizedPlan()).count("regexp_replace") <= 2 and df.first().d is not None


def test_strip_takes_what_python_takes_from_either_end(spark):
    from tallyspark.functions.text import WHITE_SPACE, py_strip
    texts = ["", "a", "a b", "~!", "\u00e9", "\u00e9 ", "\x7f", "a\u3000", "\u3000a", " ", "\u2003\u2003"]
    texts += [f"{x}mid{y}" for x in ("", "\u00df", *WHITE_SPACE) for y in ("", "\u00df", *WHITE_SPACE)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", py_strip(F.col("t")).alias("s"))
    assert all(r.s == (None if r.t is None else r.t.strip(WHITE_SPACE)) for r in df.collect())


def test_a_split_at_one_character_compiles_no_pattern(spark):
    from tallyspark.operators.parse import _plain_char
    for c in "/-. |$()[{^?*+\\],":
        assert len(_plain_char(c)) == 1 or _plain_char(c) == "\\" + c          # the forms that String.split takes as they are
        got = spark.createDataFrame([(f"a{c}b{c}{c}",)], "t string").select(F.split("t", _plain_char(c)).alias("x")).first().x
        assert got == ["a", "b", "", ""]
