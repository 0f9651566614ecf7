from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanmart.functions import scalars as sc
from loanmart.functions.calendar import date_ranges, lookback, month_window


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


def test_parse_date(spark):
    values = ["20240131", "31.01.2024", "31.01.24", "31/01/2024", "31-01-2024", "2024-01-31", "2024.01.31", "1.2.2024",
              "05.06.69", "05.06.68", "x", "", None, "20241345", "30.02.2024"]
    d = dt.date(2024, 1, 31)
    assert one(spark, values, sc.parse_date) == [
        d, d, d, d, d, d, d, dt.date(2024, 2, 1), dt.date(1969, 6, 5), dt.date(2068, 6, 5), None, None, None, None, None]


def test_clamp_date(spark):
    values = [dt.date(1, 1, 1), dt.date(1752, 12, 31), dt.date(1753, 1, 1), dt.date(2024, 1, 1), None]
    assert one(spark, values, sc.clamp_date, "date") == [
        dt.date(1753, 1, 1), dt.date(1753, 1, 1), dt.date(1753, 1, 1), dt.date(2024, 1, 1), dt.date(1900, 1, 1)]


def test_null_text(spark):
    assert one(spark, [None, "", "a"], lambda c: sc.nvl_text(c, "0")) == ["0", "0", "a"]
    assert one(spark, [None, "", "a"], lambda c: sc.concat_text(c, F.lit("-"), c)) == ["-", "-", "a-a"]
    assert one(spark, [None, ""], lambda c: sc.concat_text(c, c)) == [None, None]


def test_decode_matches_null(spark):
    fn = lambda c: sc.decode(c, (1, "one"), (None, "none"), default="-")
    assert one(spark, ["1", None, "2"], fn) == ["one", "none", "-"]
    assert one(spark, [1, None, 2], fn, "int") == ["one", "none", "-"]


def test_status_flag(spark):
    assert one(spark, [None, "0", "0.0", "3", "-1", "7", "abc"], sc.status_flag) == [0, 0, 0, 1, -1, 1, None]


def test_cut_tail(spark):
    assert one(spark, [None, "123", "123.0000000000", "1.5", "a.b"], sc.cut_tail) == [None, "123", "123", "", ""]


def test_floor_div(spark):
    assert one(spark, [150, -150, 0, -1, None], lambda c: sc.floor_div(c, 100), "bigint") == [1, -2, 0, -1, None]


def test_prefix_and_words(spark):
    assert one(spark, ["due 1", "none", None], lambda c: sc.keep_prefix(c, "due")) == ["due 1", None, None]
    assert one(spark, ["due  1   sum ", "due", " a b", "", None], sc.drop_first_word) == ["1 sum", "", "b", "", ""]


def test_polymorphic_flags(spark):
    assert one(spark, ["true", "False", "x", None], sc.poly_bool) == [True, False, None, None]
    assert one(spark, [True, False, None], sc.poly_bool, "boolean") == [True, False, None]
    assert one(spark, ["true", "false", "7", None, "x"], sc.poly_flag) == [1, 0, 7, 0, None]


def test_codes(spark):
    assert one(spark, [7, 840, 1234, None], sc.pad_code, "int") == ["007", "840", "1234", None]
    assert one(spark, ["20216840900"], lambda c: sc.sub_code(c, 6, 3)) == ["840"]
    assert one(spark, ["1,234,567", "9", "x", None], sc.number_from_text) == [1234567, 9, None, None]
    assert one(spark, [3], lambda c: sc.key_from_parts(c, F.lit(12), F.lit(4)), "int") == [31204]


def test_stamps(spark):
    at = dt.datetime(2024, 3, 5, 21, 7, 30)
    assert one(spark, [at], sc.month_stamp, "timestamp") == ["2024M03"]
    assert one(spark, [at], sc.minute_stamp, "timestamp") == ["2024-03-05 21:07"]
    assert one(spark, [at], lambda c: F.date_format(sc.shift_hours(c, 5), "yyyy-MM-dd HH:mm"), "timestamp") == [
        "2024-03-06 02:07"]
    got = one(spark, ["2024-03-05 21:07:30.250", "2024-03-05 21:07:30", "05.03.2024"],
              lambda c: F.date_format(sc.parse_timestamp(c), "HH:mm:ss.SSS"))
    assert got == ["21:07:30.250", "21:07:30.000", None]


def test_month_window_is_a_calendar_month(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 1),), (dt.date(2024, 3, 31),)], "d date")
    first, last = month_window("d", 1)
    assert [tuple(r) for r in df.select(first, last).collect()] == [
        (dt.date(2023, 2, 1), dt.date(2023, 2, 28)), (dt.date(2024, 2, 1), dt.date(2024, 2, 29))]
    start, end = lookback("d", 120)
    assert [tuple(r) for r in df.select(start, end).collect()][1] == (dt.date(2023, 11, 1), dt.date(2024, 3, 1))


def ranges(spark, start, end, period):
    df = spark.createDataFrame([(start, end)], "a date, b date")
    return [(r.range_start, r.range_end) for r in date_ranges(df, "a", "b", period).orderBy("range_start").collect()]


@pytest.mark.parametrize("period", ["day", "week", "month", "season"])
@pytest.mark.parametrize("start,end", [("2023-01-01", "2024-06-30"), ("2023-12-15", "2024-02-29"),
                                       ("2024-02-29", "2024-02-29")])
def test_ranges_tile_without_gap_or_overlap(spark, period, start, end):
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    got = ranges(spark, a, b, period)
    assert got[0][0] == a and got[-1][1] == b
    assert all(y[0] - x[1] == dt.timedelta(days=1) for x, y in zip(got, got[1:]))
    assert all(x <= y for x, y in got)


def test_season_ends(spark):
    got = ranges(spark, dt.date(2023, 1, 1), dt.date(2024, 6, 30), "season")
    assert [e for _, e in got] == [dt.date(2023, 2, 28), dt.date(2023, 5, 31), dt.date(2023, 8, 31),
                                   dt.date(2023, 11, 30), dt.date(2024, 2, 29), dt.date(2024, 5, 31),
                                   dt.date(2024, 6, 30)]


def test_unknown_period(spark):
    with pytest.raises(ValueError):
        ranges(spark, dt.date(2023, 1, 1), dt.date(2023, 1, 2), "year")
