"""Sales statistics over wide rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.dates import stat_stamp
from tillstream.functions.money import money_sum


class Stat(NamedTuple):
    """What a statistic groups by: printed name -> wide column; and the measure of the original job."""

    by: dict[str, str]
    as_coded: str


STATS = {
    "trademark": Stat({"id": "tm_id", "name": "tm_name"}, "final_detail_amount"),
    "category": Stat({"id": "category3_id", "name": "category3_name"}, "final_total_amount"),
    "spu": Stat({"id": "spu_id", "name": "spu_name"}, "final_total_amount"),
    "province": Stat({"id": "province_area_code", "name": "province_name"}, "final_total_amount"),
    "gender": Stat({"key": "user_gender"}, "final_total_amount"),
    "age": Stat({"key": "user_age_group"}, "final_total_amount"),
}


def amount_stat(wide: DataFrame, stat: str, as_coded: bool = False, stat_time: str | None = None) -> DataFrame:
    """Amount per group: (stat_time, id, name, amount) or (stat_time, key, amount).

    Sums each line's paid share. ``as_coded`` sums the measure of the original job,
    which for all but the trademark is the order's total, once per line.
    """
    by, coded = STATS[stat]
    measure = coded if as_coded else "final_detail_amount"
    stamp = stat_stamp() if stat_time is None else F.lit(stat_time)
    sums = wide.groupBy(*[F.col(c).cast("string").alias(n) for n, c in by.items()]).agg(
        money_sum(F.col(measure)).cast("double").alias("amount")
    )
    return sums.select(stamp.alias("stat_time"), *by, "amount")


def all_amount_stats(wide: DataFrame, as_coded: bool = False, stat_time: str | None = None) -> DataFrame:
    """All statistics in one pass: (stat_time, stat, id, name, amount), where a ``key`` stands as ``id`` without a name.

    The groups are grouping sets, so the wide rows are read and joined once; each task
    adds up its own rows of every set before the one shuffle.
    """
    columns = list(dict.fromkeys(c for stat in STATS.values() for c in stat.by.values()))
    measures = list(dict.fromkeys(s.as_coded if as_coded else "final_detail_amount" for s in STATS.values()))
    groups = wide.select(*[F.col(c).cast("string").alias(c) for c in columns], *measures)
    sums = groups.groupingSets([[F.col(c) for c in s.by.values()] for s in STATS.values()], *columns).agg(
        F.grouping_id(*columns).alias("_set"), *[money_sum(F.col(m)).cast("double").alias(m) for m in measures]
    )

    def pick(value) -> Column:
        """``value`` of the statistic whose columns are the ones that a row is grouped by."""
        chosen = F.lit(None).cast("string")
        for name, stat in STATS.items():
            absent = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in stat.by.values())
            chosen = F.when(F.col("_set") == absent, value(name, stat)).otherwise(chosen)
        return chosen

    stamp = stat_stamp() if stat_time is None else F.lit(stat_time)
    return sums.select(
        stamp.alias("stat_time"),
        pick(lambda name, stat: F.lit(name)).alias("stat"),
        pick(lambda name, stat: F.col(next(iter(stat.by.values())))).alias("id"),
        pick(lambda name, stat: F.col(stat.by["name"]) if "name" in stat.by else F.lit(None)).alias("name"),
        pick(lambda name, stat: F.col(stat.as_coded if as_coded else "final_detail_amount")).cast("double").alias("amount"),
    )


def _windowed(wide: DataFrame, by: Sequence[str], measure: str, window: Column) -> DataFrame:
    sums = wide.groupBy(window.alias("_window"), *by).agg(money_sum(F.col(measure)).cast("double").alias("amount"))
    return sums.select(F.col("_window.start").alias("window_start"), *by, "amount")


def amount_stat_windowed(
    wide: DataFrame,
    by: Sequence[str],
    measure: str = "final_detail_amount",
    time: str = "event_time",
    window: str = "3 seconds",
) -> DataFrame:
    """Amount per group and tumbling window; on a stream ``time`` carries a watermark."""
    return _windowed(wide, by, measure, F.window(time, window))


def sliding_amount(
    wide: DataFrame,
    by: Sequence[str],
    measure: str = "final_detail_amount",
    time: str = "event_time",
    window: str = "6 seconds",
    slide: str = "3 seconds",
) -> DataFrame:
    """Amount per group and sliding window."""
    return _windowed(wide, by, measure, F.window(time, window, slide))
