"""Column functions on hand-made edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from veinwork.functions import binning as B
from veinwork.functions import parsing as P
from veinwork.functions import temporal as T


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_flag_words(spark):
    words = [*P.TRUE_WORDS, *P.FALSE_WORDS, "maybe", "YES", " yes", "", None]
    found = values(spark, [(w,) for w in words], "w string", P.flag_from_words(F.col("w")),
                   P.known_flag_word(F.col("w")))
    assert [f for f, _ in found] == [True] * 8 + [False] * 13
    assert [k for _, k in found] == [True] * 16 + [False] * 5


def test_numbers_from_text(spark):
    texts = ["12", "12.5", " 7 ", "7.0", "1e3", "abc", "", None, "1d", "1.5f", "9007199254740993", "-4", "1e30"]
    found = values(spark, [(t,) for t in texts], "t string",
                   P.double_from_text(F.col("t")), P.whole_from_text(F.col("t")))
    assert [d for d, _ in found] == [
        12.0, 12.5, 7.0, 7.0, 1000.0, None, None, None, None, None, 9007199254740992.0, -4.0, 1e30]
    assert [w for _, w in found] == [
        12, None, 7, 7, 1000, None, None, None, None, None, 9007199254740993, -4, None]


def test_timestamps_from_text(spark):
    texts = ["09/24/2013", "2013-09-24", "2013-09-24 23:10:05", "13/40/2013", "soon", None]
    found = values(spark, [(t,) for t in texts], "t string", P.timestamp_from_text(F.col("t")))
    day = dt.datetime(2013, 9, 24)
    assert [f for f, in found] == [day, day, day.replace(hour=23, minute=10, second=5), None, None, None]


def test_hours(spark):
    texts = ["23:30:00", "25:00:00", "00:00:00", "7", None, "x:1"]
    found = values(spark, [(t,) for t in texts], "t string",
                   T.hour_of_clock(F.col("t")), T.hour_before_colon(F.col("t")))
    assert found == [(23, 23), (None, 25), (0, 0), (None, None), (None, None), (None, None)]


@pytest.mark.parametrize("style,expected", [
    ("quarters", "UNNMMAAAEEEEE"), ("late_evening", "UNMMMAAEEENNN"), ("early_evening", "-NMMMAAEENNNN")])
def test_day_bands(spark, style, expected):
    hours = [None, 0, 5, 6, 11, 12, 16, 17, 18, 21, 22, 23, 23]
    found = values(spark, [(h,) for h in hours], "h int", T.day_band(F.col("h"), style))
    letters = "".join((b or "-")[0] for b, in found)
    assert letters == expected


def test_weekend_and_season(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 7, 8), None]
    found = values(spark, [(d,) for d in days], "d date", T.day_of_week(F.col("d")),
                   T.weekend_flag(F.col("d")), T.weekday_name(F.col("d")), T.season(F.col("d")))
    assert found == [
        (4, 0, "Friday", "Winter"), (5, 1, "Saturday", "Winter"), (6, 1, "Sunday", "Winter"),
        (0, 0, "Monday", "Summer"), (None, 0, None, None)]


def test_join_date_and_clock(spark):
    rows = [(dt.date(2024, 1, 5), "10:11:12"), (dt.date(2024, 1, 5), "25:00:00"), (None, "10:11:12"),
            (dt.date(2024, 1, 5), None)]
    found = values(spark, rows, "d date, c string", T.join_date_and_clock(F.col("d"), F.col("c")))
    assert found == [(dt.datetime(2024, 1, 5, 10, 11, 12),), (None,), (None,), (None,)]


def test_ages(spark):
    years = [(2024,), (2030,), (1950,), (None,)]
    y = F.col("y")
    found = values(spark, years, "y bigint", T.years_since(y, 2024, missing="zero"),
                   T.years_since(y, 2025, clip=(0, 50)), T.years_since(y, F.lit(2026), negative_to_null=True))
    assert found == [(0, 1, 2), (-6, 0, None), (74, 50, 76), (0, None, None)]


def test_bins(spark):
    ages = [-1, 0, 3, 4, 7, 8, 15, 16, 50, 51, None]
    found = values(spark, [(a,) for a in ages], "a int", B.step_label(F.col("a"), *B.AGE_STEPS),
                   B.cut_label(F.col("a"), B.AGE_EDGES, B.AGE_LABELS))
    assert [s for s, _ in found] == [
        "New", "New", "New", "Recent", "Recent", "Middle", "Middle", "Old", "Old", "Old", "Old"]
    assert [c for _, c in found] == [
        None, "New", "New", "Recent", "Recent", "Middle", "Middle", "Old", "Old", None, None]


def test_interval_code(spark):
    found = values(spark, [(v,) for v in [0.0, 1.0, 1.5, 2.0, 3.0, 3.5, None]], "v double",
                   B.interval_code(F.col("v"), [0.0, 1.0, 2.0, 3.0]))
    assert [c for c, in found] == [0, 0, 1, 1, 2, None, None]
