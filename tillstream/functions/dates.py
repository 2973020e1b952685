"""Date and time rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def parse_day(text: Column) -> Column:
    """The leading ``yyyy-MM-dd`` of a text, whatever follows it; null where it is no date."""
    return F.try_to_date(F.regexp_extract(text, r"^\s*(\d{4}-\d{1,2}-\d{1,2})", 1), "y-M-d")


def diff_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two days given as text."""
    return F.datediff(parse_day(end), parse_day(start)).cast("bigint") * F.lit(DAY_MS)


def age_years(birthday: Column, as_of: Column | None = None) -> Column:
    """Whole days since the birthday over 365, cut toward zero; leap days are not looked at."""
    days = F.datediff(F.current_date() if as_of is None else as_of, parse_day(birthday))
    return (days / 365).cast("int")


def stat_stamp() -> Column:
    """Processing time as text."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def add_dt_hr(df: DataFrame, millis: str = "ts", zone: str = "UTC") -> DataFrame:
    """Add ``dt`` (day) and ``hr`` (two-digit hour) of an epoch time, as seen in ``zone``."""
    utc = F.expr(f"timestampadd(MILLISECOND, `{millis}`, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("string")
    return df.withColumns({"dt": F.substring(local, 1, 10), "hr": F.substring(local, 12, 2)})


def add_create_parts(df: DataFrame) -> DataFrame:
    """Split ``create_time`` text into ``create_date`` and ``create_hour``."""
    words = F.split("create_time", " ")
    return df.withColumns(
        {"create_date": words.getItem(0), "create_hour": F.split(words.getItem(1), ":").getItem(0)}
    )


def hour_of(time: Column) -> Column:
    """The hour of a ``yyyy-MM-dd HH:mm:ss`` text as a number."""
    return F.hour(F.to_timestamp_ntz(time, F.lit("yyyy-MM-dd HH:mm:ss")))
