"""Change records and app logs: parse, route, and turn rows back into messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topics and the tables that are passed on.
STARTUP_TOPIC = "STARTUP_LOG"
EVENT_TOPIC = "EVENT_LOG"
REJECTED_TOPIC = "REJECTED_LOG"
ODS_PREFIX = "ODS_"
ROUTED_TABLES = ("order_info", "order_detail")
WIDE_TOPICS = (
    "DWD_ORDER_WIDE_TM",
    "DWD_ORDER_WIDE_SPU",
    "DWD_ORDER_WIDE_CATE",
    "DWD_ORDER_WIDE_SEX",
    "DWD_ORDER_WIDE_AGE",
    "DWD_ORDER_WIDE_PROVINCE",
)

# White space only; no-break spaces count as text.
BLANK = r"^[\s\x1c-\x1f\p{Z}&&[^\u00a0\u2007\u202f]]*$"
FAILFAST = {"mode": "FAILFAST"}


def json_fields(df: DataFrame, schema: T.StructType | str, value: str = "value", options=FAILFAST) -> DataFrame:
    """The fields of a JSON column, beside all columns of ``df``.

    The generator makes sure that a text is parsed once: a filter on a field of a
    projected ``from_json`` would be pushed down with the parse and repeat it.
    """
    text = F.col(value)
    if options is FAILFAST:
        # To from_json a blank text is no broken one, but a null.
        text = F.when(F.trim(text) == "", F.raise_error(F.lit("record: blank text"))).otherwise(text)
    return df.select("*", F.inline(F.array(F.from_json(text, schema, options))))


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    given = F.when(~text.isin("", "null"), text)
    return F.coalesce(_number(given, kind), F.lit(0).cast(kind))


def _number(text: Column, kind: T.DataType) -> Column:
    """Text as a number; a whole number may be written as 5.0 or 5E0, another one in a whole-number field stops the batch."""
    if not isinstance(kind, T.IntegralType):
        return text.cast(kind)
    exact = text.cast(T.DecimalType(38, 9))
    return F.when(text.rlike("[.eE]") & (exact == F.floor(exact)), exact.cast(kind)).otherwise(text.cast(kind))


def _changes(df: DataFrame, value: str) -> DataFrame:
    """(_change, table) of change records, parsed once to a variant, which keeps all digits of the numbers in them."""
    text = F.col(value)
    whole = F.when(text.isNull() | text.rlike(r"^\s*\{"), text).otherwise(
        F.raise_error(F.lit("change record: no object"))
    )
    parsed = df.select(F.explode(F.array(F.parse_json(whole))).alias("_change"))
    return parsed.select("_change", F.variant_get("_change", "$.table", "string").alias("table"))


def parse_records(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed rows from JSON text.

    Fields are read as text first, because producers quote numbers or not.
    An absent number is 0 and an absent text is null. Broken JSON and text in a
    number field stop the batch. Columns beside ``value`` are kept.
    """
    rest = [c for c in df.columns if c != value and c not in schema.names]
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    record = json_fields(df.where(F.col(value).isNotNull()).select(value, *rest), text, value)
    return record.select(*[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema], *rest)


def parse_startup(df: DataFrame, value: str = "value") -> DataFrame:
    """Startup logs as flat rows: the fields of ``common`` and the epoch time, quoted or not."""
    schema = "common struct<mid:string,uid:string,ar:string,ch:string,vc:string>, ts string"
    time = _number(F.when(~F.col("ts").isin("", "null"), F.col("ts")), T.LongType()).alias("ts")
    return json_fields(df, schema, value).select("common.*", time, *[c for c in df.columns if c != value])


def route_logs(
    df: DataFrame,
    value: str = "value",
    startup: str = STARTUP_TOPIC,
    event: str = EVENT_TOPIC,
    rejected: str = REJECTED_TOPIC,
) -> DataFrame:
    """(topic, value): a log with a non-blank ``start`` goes to the startup topic, others to the event topic.

    A line that is no JSON object goes to the rejected topic, where the log
    endpoint answers with an error. Null and blank lines are no logs.
    """
    fields, options = "start string, _broken string", {"columnNameOfCorruptRecord": "_broken"}
    lines = json_fields(df.where(F.trim(F.col(value)) != "").select(value), fields, value, options)
    blank = F.coalesce(F.col("start").rlike(BLANK), F.lit(True))
    topic = F.when(F.col("_broken").isNotNull(), rejected).when(blank, event).otherwise(startup)
    return lines.select(topic.alias("topic"), F.col(value).alias("value"))


def route_maxwell(
    df: DataFrame, tables: Sequence[str] = ROUTED_TABLES, value: str = "value", prefix: str = ODS_PREFIX
) -> DataFrame:
    """(topic, value) for change records whose ``data`` is one object.

    Empty objects and tables that are not listed are dropped. A payload has its
    keys in order of their names; numbers keep all their digits, but trailing zeros.
    """
    listed = _changes(df, value).where(F.coalesce(F.col("table").isin(*tables), F.lit(False)))
    payload = F.explode(F.array(F.variant_get("_change", "$.data", "string"))).alias("data")
    record = listed.select("table", payload)
    wanted = (
        F.when(F.col("data").isNull(), False)
        .when(F.col("data").startswith("{"), F.col("data") != "{}")
        .otherwise(F.raise_error(F.lit("change record: data is no object")))
    )
    return record.where(wanted).select(F.concat(F.lit(prefix), F.upper("table")).alias("topic"), F.col("data").alias("value"))


def route_canal(df: DataFrame, value: str = "value", prefix: str = ODS_PREFIX) -> DataFrame:
    """(topic, value) for change records whose ``data`` is an array: one message per element."""
    data = F.variant_get("_change", "$.data", "array<string>")
    return _changes(df, value).select(
        F.concat(F.lit(prefix), F.upper("table")).alias("topic"), F.explode(data).alias("value")
    )


def to_messages(
    df: DataFrame, key: str | None = None, topic: str | Column | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows as JSON messages: nulls are left out, zeros are kept."""
    out = []
    if topic is not None:
        out.append((F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))
    if key is not None:
        out.append(F.col(key).cast("string").alias("key"))
    return df.select(*out, F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def fan_out(messages: DataFrame, topics: Sequence[str] = WIDE_TOPICS) -> DataFrame:
    """Send each message to every topic of a fixed list."""
    topic = F.explode(F.array(*[F.lit(t) for t in topics])).alias("topic")
    return messages.select(topic, *[c for c in messages.columns if c != "topic"])
