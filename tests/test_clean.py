"""P1-P10 and the reject table on the fixture-shaped statement lines."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark.config import DEFAULT
from tallyspark.operators import clean
from tallyspark.plans import catalog, synth

AXIS_HEADER = "Tran Date,CHQNO,PARTICULARS,DR,CR,BAL"


def lines_frame(spark, lines, file_name="axis_0426.csv", header=AXIS_HEADER):
    df = spark.createDataFrame([(file_name, i, l, header) for i, l in enumerate(lines)],
                               "file_name string, line_no int, line string, header string")
    return clean.header_layout(df, DEFAULT)


def test_fixture_rows(spark):
    lines = [
        ",,,,,",                                              # all null
        "01-04-2026,,UPI/P2M/1/a/food/AXIS,,,",               # 3 nulls
        "********,,x,1.00,,5.00",                             # marker
        "Generated on 02-04-2026,,x,1.00,,5.00",              # footer
        '01-04-2026,,UPI/P2M/1/a/food/AXIS,"1,234.50",,5.00',  # thousands separator
        "01-04-2026,,UPI/P2M/1/a/food/AXIS,12d,,5.00",
        "01-04-2026,,UPI/P2M/1/a/food/AXIS,abc,,5.00",
        ",9,UPI/P2M/1/a/food/AXIS,1.00,,5.00",                # null date
        "31-02-2026,,UPI/P2M/1/a/food/AXIS,1.00,,5.00",       # impossible date
        "01-04-2026,9,,1.00,,5.00",                           # null particulars
        "01-04-2026,,UPI/P2M/1/a/food/AXIS,150.00,,9850.00",  # good debit
        "2-4-2026,,UPI/P2M/2/b/tea/AXIS,,25.50,9875.50",      # good credit
    ]
    parsed = clean.parse_lines(lines_frame(spark, lines), DEFAULT)
    reasons = [r.reason for r in parsed.orderBy("line_no").collect()]
    assert reasons == ["all_null", "too_many_nulls", "marker_row", "footer_row", "bad_amount",
                       "bad_amount", "bad_amount", "null_date", "bad_date", "null_particulars", None, None]
    good = clean.cleaned(parsed).orderBy("date").collect()
    assert [(r.date, r.dr, r.cr, r.bank) for r in good] == [
        (dt.date(2026, 4, 1), Decimal("150.00"), None, "axis"),
        (dt.date(2026, 4, 2), None, Decimal("25.50"), "axis")]


def test_header_unification_and_duplicate_date_columns(spark):
    hdfc = "Date,Narration,Chq./Ref.No.,Value Dt,Withdrawal Amt.,Deposit Amt.,Closing Balance"
    ok = lines_frame(spark, ["01/04/26,UPI-a-b-1-tea,0001,01/04/26,10.00,,90.00"], "hdfc_x.csv", hdfc)
    row = clean.cleaned(clean.parse_lines(ok, DEFAULT)).first()
    assert (row.date, row.particulars, row.dr, row.bank) == (dt.date(2026, 4, 1), "UPI-a-b-1-tea", Decimal("10.00"), "hdfc")
    bad = lines_frame(spark, ["01/04/26,x,01/04/26,1.00,"], "hdfc_x.csv", "Date,Narration,Value Date,DR,CR")
    assert clean.parse_lines(bad, DEFAULT).first().reason == "bad_header"


def test_bank_tag_mismatch_is_rejected(spark):
    df = lines_frame(spark, ["01-04-2026,,UPI/P2M/1/a/food/AXIS,150.00,,9850.00"], "stmt_axis_1.csv")
    assert clean.parse_lines(df, DEFAULT).first().reason == "unknown_bank"


def test_clean_plus_rejects_is_input(spark):
    parsed = catalog.parsed_lines(spark, "/root/testdata/sf0.001")
    li = synth.read_table(spark, "/root/testdata/sf0.001", "lineitem")
    n_lines = synth.statement_lines(li, DEFAULT).count()
    assert clean.cleaned(parsed).count() + clean.rejects(parsed).count() == n_lines
    assert clean.rejects(parsed).filter(F.col("reason").isNull()).count() == 0


def test_cells_of_any_number_quotes_and_width(spark):
    wide = "Tran Date,," + ",".join(f"x{i}" for i in range(20)) + ",PARTICULARS,DR,CR"
    row = "01-04-2026,," + ",".join("v" for _ in range(20)) + ',"UPI/1/""Joe"" Bar, the/P2A/a\\b",10.00,'
    parsed = clean.parse_lines(lines_frame(spark, [row, "01-04-2026," + "," * 19 + ",x,1.00,"], header=wide), DEFAULT).orderBy("line_no").collect()
    assert parsed[0].reason is None or parsed[0].reason == "too_many_nulls"
    assert parsed[0].particulars == 'UPI/1/"Joe" Bar, the/P2A/a\\b' and parsed[1].reason == "too_many_nulls"
    cells = spark.createDataFrame([('a,"b ""c""",,"d,e",f"g,"', ), ("", )], "line string").select(clean.csv_cells(F.col("line")).alias("c")).collect()
    assert cells[0].c == ["a", 'b "c"', None, "d,e", 'f"g', '"'] and cells[1].c == [None]


def test_dates_amounts_and_white_space(spark):
    from tallyspark.functions import text
    rows = [("01-Apr-2026", dt.date(2026, 4, 1)), ("1 April 26", dt.date(2026, 4, 1)), ("2026-04-01 00:00:00", dt.date(2026, 4, 1)),
            ("1/4/2026 13:45", dt.date(2026, 4, 1)), ("01/04/98", dt.date(1998, 4, 1)), ("31-Feb-2026", None), ("Apr 2026", None), ("2026-04-01", dt.date(2026, 4, 1))]
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select("t", text.day_first_date(F.col("t")).alias("d")).collect()
    assert [r.d for r in got] == [d for _, d in rows]
    amounts = [("10", "10.00", False), (" 1.50 ", "1.50", False), ("1e30", None, True), ("99999999999999999.00", None, True), ("1.005", None, True),
               ("1.500", "1.50", False), ("12d", None, True), ("", None, False), (None, None, False), ("\u00a0", None, False)]
    got = spark.createDataFrame([(t,) for t, *_ in amounts], "t string").select(
        text.amount(F.col("t")).cast("string").alias("a"), text.bad_amount(F.col("t")).alias("bad")).collect()
    assert [(r.a, r.bad) for r in got] == [(a, b) for _, a, b in amounts]
    assert spark.range(1).select(text.py_strip(F.lit("\u00a0\u3000 x\u2003")).alias("s")).first().s == "x"


def test_key_schema_check_and_scale(spark):
    import pytest
    from tallyspark.operators import keys
    ok = "date date, particulars string, dr decimal(18,2), cr decimal(18,2)"
    row = (dt.date(2026, 4, 1), "x", Decimal("15"), None)
    for bad in (ok.replace("dr decimal(18,2)", "dr double"), ok.replace("dr decimal(18,2)", "dr decimal(18,3)"), ok.replace("date date", "date string"), ok.replace(", cr decimal(18,2)", "")):
        with pytest.raises(ValueError):
            keys.build_unique_key(spark.createDataFrame([], bad), DEFAULT)
    zero = ok.replace("dr decimal(18,2)", "dr decimal(18,0)")
    key = lambda schema, amount: keys.build_unique_key(spark.createDataFrame([(row[0], "x", Decimal(amount), None)], schema), DEFAULT).first().uuid
    assert key(zero, "15") != key(zero, "150") and key(zero, "15") == key(ok, "15")
