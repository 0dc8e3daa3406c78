"""T1-T11 on literal rows."""

import datetime as dt
from decimal import Decimal

from tallyspark.config import DEFAULT
from tallyspark.operators import parse

SCHEMA = "date date, particulars string, dr decimal(18,2), cr decimal(18,2), bank string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_axis_token_layouts(spark):
    d = dt.date(2026, 4, 1)
    rows = [
        (d, "ATM WDL 1", Decimal("1.00"), None, "axis"),
        (d, "UPI/1/shop/P2A/food", Decimal("1.00"), None, "axis"),
        (d, "UPI/P2M/123/shop/ /food/SBIN", Decimal("1.00"), None, "axis"),
        (d, "UPI/P2M/123/shop/note/food/AXIS", None, Decimal("2.00"), "axis"),
        (d, "a/b/c/d/e/f/g/h", Decimal("1.00"), None, "axis"),
    ]
    out = parse.data_preprocessor(frame(spark, rows), DEFAULT).collect()
    assert [r.len_split for r in out] == [1, 5, 6, 7, 8]
    assert [r.is_manual for r in out] == ["Y", "Y", "N", "Y", "N"]
    assert [r.raw_category for r in out] == [None, "food", "food", "food", None]
    assert [r.transaction_no for r in out] == [None, None, "123", "123", None]
    assert [r.payment_to for r in out] == [None, None, "shop", "shop", None]


def test_hdfc_split_on_hyphen_or_space(spark):
    d = dt.date(2026, 4, 1)
    rows = [(d, "UPI-shop-HDFC-999-tea", Decimal("1.00"), None, "hdfc"),
            (d, "POS 12 tea", Decimal("1.00"), None, "hdfc")]
    out = parse.data_preprocessor(frame(spark, rows), DEFAULT).collect()
    assert [r.len_split for r in out] == [5, 3]
    assert [r.transaction_no for r in out] == ["999", None]
    assert [r.transaction_type for r in out] == ["UPI", "POS"]
    assert [r.is_manual for r in out] == ["Y", "Y"]


def test_raw_category_chain_and_salary(spark):
    rows = [(dt.date(2026, 4, 1), "UPI/P2M/1/Swiggy/upi/SBIN", Decimal("1.00"), None, "axis"),
            (dt.date(2026, 4, 1), "UPI/P2M/1/x/Netflix/SBIN", Decimal("1.00"), None, "axis"),
            (dt.date(2026, 5, 17), "UPI/P2M/1/acme/sal 77001234/SBIN", None, Decimal("9.00"), "axis"),
            (dt.date(2026, 6, 1), "UPI/P2M/1/acme/SAL 77001234/SBIN", None, Decimal("9.00"), "axis"),
            (dt.date(2026, 4, 1), "UPI/P2M/1/x/ swigy /SBIN", Decimal("1.00"), None, "axis"),
            (dt.date(2026, 4, 1), "ATM WDL 1", Decimal("1.00"), None, "axis")]
    df = parse.data_preprocessor(frame(spark, rows), DEFAULT)
    df = parse.clean_raw_category(df, DEFAULT)
    df = parse.apply_raw_category_transformation(df, DEFAULT)
    df = parse.capitalize_raw_category(df)
    df = parse.modify_salaried_record(df, DEFAULT)
    out = df.collect()
    assert out[0].raw_category == "Swiggy"           # generic -> payee
    assert out[1].raw_category == "Netflix"          # capital map key never matches
    assert (out[2].raw_category, out[2].date) == ("Salary", dt.date(2026, 6, 1))
    assert out[3].date == dt.date(2026, 7, 1)        # a 1st also moves a month
    assert out[4].raw_category == "Swigy"            # padded value misses the map
    assert (out[5].raw_category, out[5].payment_to) == ("Unspecified", "none")
