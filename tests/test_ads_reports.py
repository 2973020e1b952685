import pytest
from pyspark.sql import functions as F

from tillstream.operators import reports
from tillstream.operators.ads import STATS, all_amount_stats, amount_stat, amount_stat_windowed, sliding_amount
from tillstream.operators.dws import wide_row
from tillstream.session import work_dir
from tillstream.sources.readers import read_wide
from tillstream.sources.writers import append_daily

WIDE = (
    "order_id bigint, order_detail_id bigint, tm_id bigint, tm_name string, user_gender string, "
    "final_total_amount double, final_detail_amount double, dt string, create_time string"
)


@pytest.fixture
def wide(spark):
    rows = [
        (1, 1, 3, "a_b:c", "女", 30.0, 10.1, "2020-06-01", "2020-06-01 09:10:00"),
        (1, 2, 3, "a_b:c", "女", 30.0, 19.9, "2020-06-01", "2020-06-01 09:10:00"),
        (2, 3, 4, None, None, 5.0, 5.0, "2020-06-01", "2020-06-01 21:00:00"),
        (3, 4, 4, "", None, 7.0, 7.0, "2020-06-02", "2020-06-02 00:00:00"),
    ]
    return wide_row(spark.createDataFrame(rows, WIDE))


def test_names_with_separators_and_nulls_stay_whole(wide, rows):
    got = rows(amount_stat(wide, "trademark", stat_time="now"))
    assert got == [("now", "3", "a_b:c", 30.0), ("now", "4", "", 7.0), ("now", "4", None, 5.0)]


def test_as_coded_counts_the_order_once_per_line(wide, rows):
    assert rows(amount_stat(wide, "gender", stat_time="t")) == [("t", "女", 30.0), ("t", None, 12.0)]
    assert rows(amount_stat(wide, "gender", True, "t")) == [("t", "女", 60.0), ("t", None, 12.0)]


def test_every_statistic_has_its_columns(wide):
    for name, stat in STATS.items():
        assert amount_stat(wide, name).columns == ["stat_time", *stat.by, "amount"]


@pytest.mark.parametrize("as_coded", [False, True])
def test_all_statistics_at_once(wide, rows, plan, as_coded):
    """Each statistic as by itself: a null group of one is told apart from the columns that another does not group by."""
    single = set()
    for name, stat in STATS.items():
        for r in amount_stat(wide, name, as_coded, "t").collect():
            single.add((name, r["id" if "id" in stat.by else "key"], r["name"] if "name" in stat.by else None, r["amount"]))
    together = all_amount_stats(wide, as_coded, "t")
    assert together.columns == ["stat_time", "stat", "id", "name", "amount"]
    assert sorted(single, key=repr) == rows(together, "stat", "id", "name", "amount")
    assert plan(together).count("Exchange") == 1 and "partial_sum" in plan(together)
    assert rows(all_amount_stats(wide.limit(0))) == []


def test_reports_read_the_days_of_a_table(spark, wide, rows, plan):
    path = work_dir(spark, "stored")
    for batch_id, part in ((0, F.col("order_detail_id") < 3), (1, F.col("order_detail_id") >= 3)):
        append_daily(wide.where(part), f"{path}/wide", batch_id)
    days = [("2020-06-01", "yes"), ("2020-06-02", "no"), ("2021-01-01", "yes"), ("2020-06-01", "yes")]
    spark.createDataFrame(days, "dt string, report string").write.parquet(f"{path}/days")
    wanted = spark.read.parquet(f"{path}/days").where("report = 'yes'")
    report = reports.order_amount_days(read_wide(spark, f"{path}/wide"), wanted)
    assert "dynamicpruning" in plan(report)
    assert rows(report) == [("2020-06-01", 3, 35.0)]


def test_sums_combine_before_the_shuffle(wide, plan):
    assert "partial_sum" in plan(amount_stat(wide, "trademark"))


def test_windows(wide, rows):
    timed = wide.withColumn("event_time", F.timestamp_seconds(F.col("order_detail_id") * 2 + 2000))

    # Lines at 2002, 2004, 2006 and 2008.
    def at(df):
        return rows(df.withColumn("window_start", F.unix_seconds("window_start")))

    assert at(amount_stat_windowed(timed, [])) == [(2001, 10.1), (2004, 24.9), (2007, 7.0)]
    assert at(sliding_amount(timed, [])) == [(1998, 10.1), (2001, 35.0), (2004, 31.9), (2007, 7.0)]


def test_day_reports(wide, rows):
    assert rows(reports.order_amount(wide, "2020-06-01")) == [(35.0,)]
    assert rows(reports.order_amount(wide, "1999-01-01")) == [(0.0,)]
    assert rows(reports.order_amount_hour(wide, "2020-06-01")) == [("21", 5.0), ("9", 30.0)]


def test_dau_reports(spark, rows):
    dau = spark.createDataFrame(
        [("2020-06-01", "09")] * 3 + [("2020-06-01", "07")] + [("2020-06-02", "09")], "dt string, hr string"
    )
    assert rows(reports.dau_total(dau, "2020-06-01")) == [(4,)]
    assert rows(reports.dau_total(dau, "2020-07-01")) == [(0,)]
    assert [tuple(r) for r in reports.dau_hour(dau, "2020-06-01").collect()] == [("09", 3), ("07", 1)]


def test_realtime_total_shows_real_values(spark, wide, rows):
    dau = spark.createDataFrame([("2020-06-01", "m")], "dt string, mid string")
    assert rows(reports.realtime_total(dau, wide, "2020-06-01")) == [
        ("dau", "新增日活", "1"),
        ("order_amount", "订单金额", "35.00"),
    ]
