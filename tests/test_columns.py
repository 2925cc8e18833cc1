import datetime as dt

import pytest
from pyspark.sql import functions as F

from innkeeper.functions import columns as C


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_currency(spark):
    got = one_col(spark, ["$1,234.50", "-$5.00", "", "abc", "12d", "nan", None], C.parse_currency)
    assert got == [1234.5, -5.0, None, None, None, None, None]


def test_currency_is_idempotent_on_numbers(spark):
    assert one_col(spark, ["1234.5"], lambda c: C.parse_currency(C.parse_currency(c))) == [1234.5]


def test_lenient_number(spark):
    got = one_col(spark, [" 12 ", "1e3", "7f", "nan", "-.5", "+3.", "inf", None], C.parse_number)
    assert got[:6] == [12.0, 1000.0, None, None, -0.5, 3.0]
    assert got[6] == float("inf") and got[7] is None


def test_parse_int_truncates(spark):
    assert one_col(spark, ["3.9", "x", "12"], C.parse_int) == [3, None, 12]


def test_flag(spark):
    assert one_col(spark, ["t", "f", "x", None], C.parse_flag) == [True, False, None, None]


def test_flag_to_bit(spark):
    assert one_col(spark, [True, False, None], C.flag_to_bit, "boolean") == [1, 0, None]


def test_date(spark):
    got = one_col(spark, ["2026-02-03", "2026-02-30", "2026/02/03", None], C.parse_date)
    assert got == [dt.date(2026, 2, 3), None, None, None]


def test_strip_and_blank(spark):
    got = one_col(spark, ["\ta ", "   ", " NA ", "n/a", "x y "], C.clean_text)
    assert got == ["a", None, None, None, "x y"]


def test_strip_keeps_inner_whitespace(spark):
    assert one_col(spark, ["\n a\tb \r\n"], C.strip_text) == ["a\tb"]


def test_strict_bigint(spark):
    assert one_col(spark, [" 12", "-3", None], C.strict_bigint) == [12, -3, None]
    with pytest.raises(Exception, match="not an integer"):
        one_col(spark, ["12.5"], C.strict_bigint)


def test_date_dimension_attributes(spark):
    df = spark.createDataFrame([(dt.date(2027, 1, 1),)], "d date")
    attrs = C.date_attributes("d")
    row = df.select(*[v.alias(k) for k, v in attrs.items()]).first().asDict()
    assert row["date_key"] == 20270101
    assert row["month_name"] == "January" and row["day_name"] == "Friday"
    assert row["quarter"] == 1 and row["day_of_week"] == 5 and row["week_of_year"] == 53
    assert row["month_key"] == 202701


def test_day_of_week_monday_is_one(spark):
    df = spark.createDataFrame([(dt.date(2026, 12, 7),), (dt.date(2026, 12, 13),)], "d date")
    assert [r[0] for r in df.select(C.day_of_week("d")).collect()] == [1, 7]


def test_composite_key_nulls_as_empty(spark):
    df = spark.createDataFrame([(1, 2), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(C.composite_key("a", "b")).collect()] == ["1-2", "-2"]


def test_results_do_not_depend_on_ansi_mode(spark):
    values = ["$1,234.50", "abc", None]
    before = one_col(spark, values, C.parse_currency)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert one_col(spark, values, C.parse_currency) == before
        assert one_col(spark, ["2026-02-30"], C.parse_date) == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
