import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbmart.functions import tokens as tk


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


def test_count_keeps_gaps_apart_and_reported_zero_stays_zero(spark):
    raw = ["0", " 42 ", "*", "", None, " na ", "NA", "20.5", "-1", "12\n", "x"]
    assert apply(spark, tk.count_value, raw) == [
        Decimal(0), Decimal(42), None, None, None, None, None, None, None, None, None]
    assert apply(spark, tk.count_status, raw) == [
        "reported", "reported", "suppressed", "unavailable_blank", "unavailable_blank",
        "unavailable_na", "unavailable_na", "invalid_numeric", "invalid_numeric",
        "invalid_numeric", "invalid_numeric"]


def test_count_beyond_precision_is_invalid(spark):
    raw = ["9" * 38, "9" * 39]
    assert apply(spark, tk.count_status, raw) == ["reported", "invalid_numeric"]


def test_rate_rounds_at_ten_places(spark):
    raw = [" 0.0200 ", "1e-3", "0.00000000005", "-1.5", "NA", "?"]
    assert apply(spark, tk.rate_value, raw) == [
        Decimal("0.0200000000"), Decimal("0.0010000000"), Decimal("0.0000000001"),
        Decimal("-1.5000000000"), None, None]
    assert apply(spark, tk.rate_status, raw)[-2:] == ["unavailable_na", "invalid_numeric"]


def test_score_sentinel_and_null(spark):
    raw = ["0", "0.75", "-999", " -999 ", None, "", "BROKEN", "-999.0"]
    assert apply(spark, tk.score_status, raw) == [
        "reported", "reported", "unavailable_sentinel", "unavailable_sentinel",
        "unavailable_null", "invalid_numeric", "invalid_numeric", "reported"]
    assert apply(spark, tk.score_value, raw)[2:5] == [None, None, None]


def test_availability_depends_on_measure(spark):
    raw = ["001", " 001 ", "199", "260", "999", None]
    assert apply(spark, tk.availability_status, raw) == [
        "available", "available", "not_available", "invalid", "invalid", "invalid"]
    star = apply(spark, lambda x: tk.availability_status(x, star=True), raw)
    assert star[3] == "not_available"
    assert apply(spark, tk.unavailability_reason, ["258", "001", None]) == [
        "insufficient_history", None, None]


@pytest.mark.parametrize("text,start,end", [
    ("01Jan2021-31Dec2024", datetime.date(2021, 1, 1), datetime.date(2024, 12, 31)),
    (" 1jan2021-5FEB2022 ", datetime.date(2021, 1, 1), datetime.date(2022, 2, 5)),
    ("31Feb2021-x", None, None), ("", None, None), (None, None, None),
])
def test_periods(spark, text, start, end):
    assert apply(spark, tk.period_start, [text]) == [start]
    assert apply(spark, tk.period_end, [text]) == [end]


def test_numbers_dates_and_flags(spark):
    assert apply(spark, tk.whole_number, ["4.6", "4.5", "-4.5", "1e3", "", "abc", "99999999999"]) == [
        5, 5, -5, 1000, None, None, None]
    assert apply(spark, tk.full_date, ["2020-1-2", "2020/01/02", "2020-01", "2020-13-01", None]) == [
        datetime.date(2020, 1, 2), datetime.date(2020, 1, 2), None, None, None]
    assert apply(spark, tk.yes_no, ["YES", " no ", "maybe", None]) == [True, False, None, None]
    assert apply(spark, tk.outcome_category, [" Worse than Expected ", "other"]) == [
        "worse_than_expected", None]


def test_epoch_text_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1734556371999,), (None,), (0,), (-1,), (1,)], "x bigint")
        got = [r.y for r in df.select(tk.epoch_millis_text("x").alias("y")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-12-18T21:12:51Z", None, None, None, "1970-01-01T00:00:00Z"]


def test_triple_names_and_value_status_agreement(spark):
    df = spark.createDataFrame([("*",), ("1",), ("x",)], "A string").select(*tk.triple("A", "m", "rate"))
    assert df.columns == ["m_raw", "m", "m_status"]
    assert df.where((F.col("m_status") == "reported") != F.col("m").isNotNull()).count() == 0
