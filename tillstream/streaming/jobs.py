"""Jobs: message streams in, tables and messages out.

Each job is one streaming query whose checkpoint carries offsets and state. Its
``foreachBatch`` function writes folders named by the batch, so that a batch which
is run again after a failure leaves the same result. Messages go to a folder, or to
what the caller gives in its place, such as ``topic_sink``.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas
from tillstream.functions.dates import add_create_parts
from tillstream.operators.ads import STATS, amount_stat
from tillstream.operators.dau import DAU_KEYS, dau_document
from tillstream.operators.dwd import (
    enrich_detail,
    enrich_order,
    flag_first_order,
    latest_orders,
)
from tillstream.operators.dws import first_arrived, first_seen, join_orders
from tillstream.operators.ods import parse_records, to_messages
from tillstream.sources.files import exists
from tillstream.sources.keyed import KeyedTable, keys_of
from tillstream.sources.readers import ARRIVAL
from tillstream.sources.writers import Send, append_daily, append_exactly_once, folder_sink, write_stream
from tillstream.streaming.state import ORDER, first_starts, milliseconds, newcomers, split_stream, with_newcomers

Transform = Callable[[DataFrame], DataFrame]

DEDUP_LIFE = "24 hours"
SPLIT_LIFE = "1 hour"


def _sink(send: str | Send) -> Send:
    return send if callable(send) else folder_sink(send)


@contextmanager
def _reused(df: DataFrame):
    """One batch that several outputs read."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _empty(kept: DataFrame) -> bool:
    """Whether a persisted batch has no rows. The count fills all of it at once; ``isEmpty`` would begin with a single task."""
    return kept.count() == 0


def _arrived(batch: DataFrame) -> DataFrame:
    """The messages of a batch with their order; without one of the source, that in which the batch's tasks read them."""
    return batch if ARRIVAL in batch.columns else batch.withColumn(ARRIVAL, F.monotonically_increasing_id())


def message_job(
    messages: DataFrame, route: Transform, send: str | Send, checkpoint: str, **run
) -> StreamingQuery:
    """Route or reshape messages and send them on by topic: the log and change-record routers."""
    return write_stream(route(messages), _sink(send), checkpoint, **run)


def dim_job(
    messages: DataFrame, schema: T.StructType, table: KeyedTable, checkpoint: str, build: Transform | None = None, **run
) -> StreamingQuery:
    """Keep a dimension table up to date; ``build`` looks other tables up again in each batch."""

    def each(batch: DataFrame, n: int) -> None:
        with _reused(_arrived(batch).select("value", ARRIVAL)) as messages:
            if _empty(messages):
                return
            table.tidy(n)
            records = parse_records(messages, schema)
            last = first_seen(records, table.keys, [F.col(ARRIVAL).desc()]).drop(ARRIVAL)
            table.upsert(last if build is None else build(last), n, [])

    return write_stream(messages, each, checkpoint, **run)


def _snapshot(orders: DataFrame, consumed: DataFrame | None, checkpoint: str) -> DataFrame:
    """The users of ``consumed`` as a stream that ends with the first batch; kept beside the offsets, written once."""
    spark, path = orders.sparkSession, f"{checkpoint}/consumed"
    schema = T.StructType([orders.schema["user_id"]])
    if not exists(spark, f"{path}/_SUCCESS"):
        empty = spark.createDataFrame([], schema)
        users = empty if consumed is None else consumed.select(F.col("user_id").cast(schema["user_id"].dataType))
        marked = users.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        marked.mode("overwrite").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def order_info_job(
    messages: DataFrame,
    consumed: DataFrame | None,
    orders: KeyedTable,
    province: KeyedTable,
    user: KeyedTable,
    send: str | Send,
    checkpoint: str,
    **run,
) -> StreamingQuery:
    """Order facts: first-order flag against the users seen before, province and user attributes.

    Who has ordered is state of the query. ``consumed`` (user_id) has those who ordered before it was started for
    the first time; a query that goes on from its checkpoint does not look at it. Of several messages of one order
    in a batch the last one stays if ``messages`` has the order of the source (``arrival``), else any of them.
    """
    columns = [c for c in ("value", ARRIVAL) if c in messages.columns]
    parsed = parse_records(messages.select(*columns), schemas.ORDER_RECORD)

    def each(batch: DataFrame, n: int) -> None:
        with _reused(batch) as rows:
            if _empty(rows):
                return
            sent = rows.where(F.col("_kind") == ORDER).drop("_kind")
            orders.tidy(n)
            latest = latest_orders(_arrived(sent), ARRIVAL).drop(ARRIVAL)
            records = flag_first_order(add_create_parts(latest), newcomers=newcomers(rows))
            users = user.read(only=keys_of(sent, "user_id", user))
            rich = enrich_order(records, province.read(), users)
            with _reused(rich.select(*schemas.ORDER_INFO.names)) as facts:
                orders.upsert(facts, n, None)
                _sink(send)(to_messages(facts, key="id"), n)

    return write_stream(with_newcomers(parsed, _snapshot(parsed, consumed, checkpoint)), each, checkpoint, **run)


def order_detail_job(
    messages: DataFrame, sku: KeyedTable, details: KeyedTable, send: str | Send, checkpoint: str, **run
) -> StreamingQuery:
    """Order-line facts with the attributes of their SKU.

    Only the SKU ids of a batch are kept while it runs: its messages are read once for them and once for the
    lines, and what is sent comes from the stored lines.
    """
    refers = T.StructType([schemas.DETAIL_RECORD["sku_id"]])

    def each(batch: DataFrame, n: int) -> None:
        with _reused(keys_of(parse_records(batch.select("value"), refers), "sku_id", sku)) as skus:
            if _empty(skus):
                return
            details.tidy(n)
            parsed = parse_records(_arrived(batch).select("value", ARRIVAL), schemas.DETAIL_RECORD)
            lines = first_seen(parsed, ["id"], [F.col(ARRIVAL).desc()]).drop(ARRIVAL)
            facts = enrich_detail(lines, sku.read(only=skus)).select(*schemas.ORDER_DETAIL.names)
            details.upsert(facts, n, None)
        _sink(send)(to_messages(details.written(n), key="id"), n)

    return write_stream(messages, each, checkpoint, **run)


def wide_stream(
    orders: DataFrame,
    lines: DataFrame,
    order_time: str,
    line_time: str,
    delay: str = "10 minutes",
    within_watermark: bool = True,
    salts: int = 4,
    repeats: bool = True,
    line_repeats: bool = False,
) -> DataFrame:
    """Orders joined with their lines, each line once. Either may be sent more than once; where lines often are,
    ``line_repeats`` keeps their copies out of the join's state."""
    joined = join_orders(
        orders, lines, order_time, line_time, delay=delay, salts=salts, repeats=repeats, line_repeats=line_repeats
    )
    return first_arrived(joined, ["order_detail_id"], within_watermark, salts)


def order_wide_job(
    wide: DataFrame,
    path: str,
    checkpoint: str,
    messages: str | Send | None = None,
    life: str = SPLIT_LIFE,
    daily: bool = True,
    **run,
) -> StreamingQuery:
    """Split the paid totals over the lines of a wide stream and store the rows, by day with ``daily``.

    The sums of an order whose lines are still coming in are state of the query; they count for ``life`` after
    the order's last line, and then go.
    """
    store = append_daily if daily else append_exactly_once

    def each(batch: DataFrame, n: int) -> None:
        with _reused(batch) as rows:
            if _empty(rows):
                return
            store(rows, path, n)
            if messages:
                _sink(messages)(to_messages(rows, columns=schemas.ORDER_WIDE.names), n)

    split = split_stream(wide, milliseconds(wide.sparkSession, life))
    return write_stream(split, each, checkpoint, **run)


def stat_job(
    messages: DataFrame, stat: str, path: str, checkpoint: str, as_coded: bool = False, **run
) -> StreamingQuery:
    """One statistic per micro-batch of wide messages; rows and progress are stored together."""
    used = {*STATS[stat].by.values(), STATS[stat].as_coded if as_coded else "final_detail_amount"}
    fields = T.StructType([f for f in schemas.ORDER_WIDE if f.name in used])

    def each(batch: DataFrame, n: int) -> None:
        with _reused(parse_records(batch.select("value"), fields)) as wide:
            if not _empty(wide):
                append_exactly_once(amount_stat(wide, stat, as_coded), path, n)

    return write_stream(messages, each, checkpoint, **run)


def dau_stream(
    logs: DataFrame, life: str | None = DEDUP_LIFE, zone: str = "UTC", salts: int = 4, late: str = "1 hour"
) -> DataFrame:
    """The first startup of each device and day. A device is remembered for ``life`` after its last start of the day,
    or for ever with None.

    The time that counts is that of arrival: the topic's ``timestamp`` if ``logs``
    has it, else the clock when the batch is read. A device's own clock only
    gives the day, so a wrong one loses no other device. Logs that arrive later than
    others by more than ``late`` are dropped.
    """
    if life is None:
        return first_arrived(dau_document(logs, zone=zone).select(*schemas.DAU_INFO.names), DAU_KEYS, False, salts)
    at = F.col("timestamp") if "timestamp" in logs.columns else F.current_timestamp()
    documents = dau_document(logs.withColumn("_at", at), zone=zone).withWatermark("_at", late)
    return first_starts(documents.select(*schemas.DAU_INFO.names, "_at"), milliseconds(logs.sparkSession, life), "_at")


def dau_job(
    logs: DataFrame, path: str, checkpoint: str, life: str | None = DEDUP_LIFE, zone: str = "UTC", salts: int = 4, **run
) -> StreamingQuery:
    """Add the first startup of each device to the index of its day."""
    documents = dau_stream(logs, life, zone, salts).select(*schemas.DAU_INFO.names)
    return write_stream(documents, lambda df, n: append_daily(df, path, n), checkpoint, **run)
