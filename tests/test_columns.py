import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from staffhouse.functions import columns as C
from staffhouse.functions import measures as MS


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_clean_number(spark):
    out = one(spark, C.clean_number("x"), [("1,50",), ("",), (None,), ("12",)], "x string")
    assert out == [1.5, None, None, 12.0]
    assert one(spark, C.clean_number("x", strict=False), [("a,b",)], "x string") == [None]


def test_hhmm_to_hours(spark):
    out = one(spark, C.hhmm_to_hours("x"), [("08:20",), ("8:20",), ("",), (None,), ("00:30",), ("10:50",)],
              "x string")
    assert out == [Decimal("8.33"), None, None, None, Decimal("0.50"), Decimal("10.83")]


def test_minutes_to_hhmm_negative_is_null(spark):
    out = one(spark, C.minutes_to_hhmm("n"), [(90,), (-30,), (0,), (None,)], "n int")
    assert out == ["01:30", None, "00:00", None]


def test_break_minutes(spark):
    out = one(spark, C.minutes_between(F.lit("12:00"), F.col("e")), [("12:45",), ("",), ("11:30",)], "e string")
    assert out == [45, None, -30]


def test_pg_left_right_negative(spark):
    df = spark.createDataFrame([("5,00",), ("abc",), (None,)], "x string")
    r = df.select(C.pg_left("x", -1), C.pg_right("x", -1), C.pg_left("x", 2), C.pg_right("x", 2)).collect()
    assert tuple(r[0]) == ("5,0", ",00", "5,", "00")
    assert tuple(r[1]) == ("ab", "bc", "ab", "bc")
    assert tuple(r[2]) == (None, None, None, None)


def test_split_pair_formats(spark):
    df = spark.createDataFrame([("1,00 / 8,00",), ("1,00 / 10,00",), ("5,00",), ("",)], "x string")
    md, h = C.split_pair("x")
    r = [tuple(x) for x in df.select(md, h).collect()]
    assert r[0] == (1.0, 8.0)
    assert r[1] == (1.0, 10.0)
    assert r[2] == (5.0, 0.0)          # no separator: drop one char at each end
    assert r[3] == (None, None)


def test_safe_add_subtract(spark):
    df = spark.createDataFrame([(1.0, None, 2.0)], "a double, b double, c double")
    r = df.select(C.safe_add("a", "b", "c"), C.safe_subtract("c", "a", "b")).first()
    assert tuple(r) == (3.0, 1.0)


def test_div_cents_truncates(spark):
    out = one(spark, C.div_cents("x"), [(1999,), (-150,), (None,), (99,)], "x bigint")
    assert out == [19, -1, None, 0]


def test_hourly_rate_exact(spark):
    df = spark.createDataFrame([(5000, 40, "monthly"), (30, 40, "hourly"), (5000, None, "monthly"),
                                (5000, 0, "monthly")], "a bigint, h bigint, f string")
    out = [r[0] for r in df.select(C.hourly_rate("a", "h", "f")).collect()]
    assert out == [Decimal("28.85"), Decimal("30.00"), None, None]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 1, 7),)], "d date")
    r = df.select(C.isodow("d"), C.iso_week("d"), C.day_name("d"), C.week_year("d")).collect()
    assert tuple(r[0]) == (1, 1, "Monday   ", "012024")
    assert tuple(r[1]) == (7, 1, "Sunday   ", "012024")


def test_bands_and_compliance(spark):
    df = spark.createDataFrame([(6.0, None), (6.01, 0.5), (9.0, 0.25), (9.01, 1.0), (None, None), (3.0, None)],
                               "w double, b double")
    legal = C.legal_break_hours("w")
    r = [tuple(x) for x in df.select(legal, C.compliance(legal, F.col("b"))).collect()]
    assert r == [(Decimal("0.00"), "O"), (Decimal("0.50"), "O"), (Decimal("0.50"), "X"), (Decimal("0.75"), "O"),
                 (None, None), (Decimal("0.00"), "O")]


def test_rating_digit(spark):
    assert one(spark, C.rating_digit("r"), [("4 🙂",), ("3-MEDIUM",)], "r string") == [4, 3]


def test_measures(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29), dt.date(2023, 2, 28))], "b date, a date")
    r = df.select(MS.age("b", "a"), MS.next_anniversary("b", "a"), MS.tenure_text("b", F.lit(None).cast("date"), "a")).first()
    assert r[0] == 22
    assert r[1] == dt.date(2023, 2, 28)
    assert r[2] == "22 Jahre, 11 Monate"
