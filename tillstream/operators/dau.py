"""Daily active devices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.dates import add_dt_hr
from tillstream.operators.ods import parse_startup
from tillstream.schemas import DAU_INFO

DAU_KEYS = ("dt", "mid")


def dau_document(logs: DataFrame, value: str = "value", zone: str = "UTC") -> DataFrame:
    """Startup logs as documents of the daily index; columns beside ``value`` are kept."""
    rows = add_dt_hr(parse_startup(logs, value), "ts", zone).withColumn("mi", F.lit("00"))
    return rows.select(*DAU_INFO.names, *[c for c in logs.columns if c != value])
