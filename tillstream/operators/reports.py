"""Reports over the daily index and the wide fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.dates import hour_of
from tillstream.functions.money import MONEY, money_sum

HOURS = 24

# Ids and titles of the report cards.
DAU_CARD = ("dau", "新增日活")
AMOUNT_CARD = ("order_amount", "订单金额")


def _amount() -> Column:
    return F.coalesce(money_sum(F.col("final_detail_amount")), F.lit(0).cast(MONEY))


def order_amount(wide: DataFrame, dt: str) -> DataFrame:
    """Paid amount of a day: one row, 0 where nothing was sold."""
    return wide.where(F.col("dt") == dt).agg(_amount().cast("double").alias("order_amount"))


def order_amount_hour(wide: DataFrame, dt: str) -> DataFrame:
    """Paid amount of a day per hour of the order's creation."""
    hour = hour_of(F.col("create_time")).cast("string").alias("hr")
    return wide.where(F.col("dt") == dt).groupBy(hour).agg(_amount().cast("double").alias("order_amount"))


def order_amount_days(wide: DataFrame, days: DataFrame) -> DataFrame:
    """(dt, lines, order_amount) of the days of a table (``dt``), for a wide fact that is stored by day.

    A day without sales has no row, a day that stands twice counts once. The days are
    known only when the query runs; where Spark finds their table small enough to
    broadcast, and it is filtered by a comparison (a bare boolean column does not
    count as one), only the folders of its days are read.
    """
    wanted = wide.join(days.select("dt"), "dt", "left_semi")
    return wanted.groupBy("dt").agg(F.count("*").alias("lines"), _amount().cast("double").alias("order_amount"))


def dau_total(dau: DataFrame, dt: str) -> DataFrame:
    """Number of devices that were active on a day."""
    return dau.where(F.col("dt") == dt).agg(F.count("*").alias("total"))


def dau_hour(dau: DataFrame, dt: str) -> DataFrame:
    """Devices per hour of their first start on a day: the 24 largest hours."""
    hours = dau.where(F.col("dt") == dt).groupBy("hr").agg(F.count("*").alias("total"))
    return hours.orderBy(F.desc("total"), "hr").limit(HOURS)


def realtime_total(dau: DataFrame, wide: DataFrame, dt: str) -> DataFrame:
    """The day's cards as (id, name, value)."""

    def card(row: DataFrame, labels: tuple[str, str], value: Column) -> DataFrame:
        return row.select(F.lit(labels[0]).alias("id"), F.lit(labels[1]).alias("name"), value.alias("value"))

    amount = wide.where(F.col("dt") == dt).agg(_amount().alias("v"))
    return card(dau_total(dau, dt), DAU_CARD, F.col("total").cast("string")).unionByName(
        card(amount, AMOUNT_CARD, F.col("v").cast("string"))
    )
