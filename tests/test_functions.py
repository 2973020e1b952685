import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream.functions.dates import add_create_parts, add_dt_hr, age_years, diff_ms, hour_of, parse_day, stat_stamp
from tillstream.functions.labels import age_group, gender_label
from tillstream.functions.money import cents, line_amount, round_cents


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_age_is_days_over_365(table):
    days = table(
        "b string",
        ("2000-01-01",),
        ("2006-01-06",),  # 20 * 365 days before
        ("2006-01-07",),
        ("2026-06-01",),
        ("2028-01-01",),
        ("1990-05-06 12:00:00",),
        ("1990-5-6",),
        ("2020-13-45",),
        ("soon",),
        (None,),
    )
    ages = one(days, age_years(F.col("b"), F.lit("2026-01-01").cast("date")))
    assert ages == [26, 20, 19, 0, -2, 35, 35, None, None, None]


def test_age_defaults_to_today(table):
    assert one(table("b string", ("1970-01-01",)), age_years(F.col("b")))[0] >= 55


def test_diff_ms(table):
    df = table("a string, b string", ("2024-02-28", "2024-03-01"), ("2024-03-01", "2024-02-28"), (None, "2024-01-01"))
    assert one(df, diff_ms(F.col("a"), F.col("b"))) == [172_800_000, -172_800_000, None]


def test_parse_day_takes_the_leading_day(table):
    df = table("d string", ("2024-02-29 23:59:59",), ("2023-02-29",), ("",))
    assert [str(d) for d in one(df, parse_day(F.col("d")))] == ["2024-02-29", "None", "None"]


def test_age_groups(table):
    df = table("age int", (19,), (20,), (29,), (30,), (-1,), (None,))
    assert one(df, age_group(F.col("age"))) == ["20岁以下", "20岁到30岁", "20岁到30岁", "30岁以上", "20岁以下", None]


def test_gender_labels(table):
    df = table("g string", ("F",), ("M",), ("",), ("f",), ("X",), (None,))
    assert one(df, gender_label(F.col("g"))) == ["女", "男", "保密", "保密", "保密", "保密"]


def test_round_cents_is_not_decimal_rounding(table):
    df = table("x double", (1.005,), (2.675,), (0.0,), (-1.005,), (-0.005,), (0.125,))
    assert one(df, round_cents(F.col("x"))) == [1.0, 2.68, 0.0, -1.0, 0.0, 0.13]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=50, max_size=200))
def test_cents_follow_the_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert one(df, cents(F.col("x"))) == [math.floor(v * 100 + 0.5) for v in values]


def test_line_amount(table):
    assert one(table("n bigint, p double", (3, 2.5), (0, 9.0)), line_amount(F.col("n"), F.col("p"))) == [7.5, 0.0]


def test_dt_and_hr_follow_the_zone(table, rows):
    df = table("ts bigint", (1592400000000,), (1592409600000,))  # 2020-06-17 13:20 and 16:00 UTC
    assert rows(add_dt_hr(df), "dt", "hr") == [("2020-06-17", "13"), ("2020-06-17", "16")]
    assert rows(add_dt_hr(df, zone="Asia/Shanghai"), "dt", "hr") == [("2020-06-17", "21"), ("2020-06-18", "00")]


def test_dt_and_hr_do_not_depend_on_the_session(spark, table, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows(add_dt_hr(table("ts bigint", (1592409600000,))), "dt", "hr") == [("2020-06-17", "16")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_create_parts(table, rows):
    df = add_create_parts(table("create_time string", ("2020-06-23 14:55:01",)))
    assert rows(df, "create_date", "create_hour") == [("2020-06-23", "14")]


def test_hour_of(table):
    assert one(table("t string", ("2020-06-23 04:55:01",)), hour_of(F.col("t"))) == [4]


def test_stat_stamp(table):
    assert len(one(table("x int", (1,)), stat_stamp())[0]) == len("2020-06-23 04:55:01")


def test_broken_time_stops_the_query(table):
    with pytest.raises(Exception):
        one(table("t string", ("yesterday",)), hour_of(F.col("t")))
