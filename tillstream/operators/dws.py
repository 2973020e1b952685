"""Order wide facts: join orders with their lines, remove repeats, split the paid total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstream.functions.money import cents, line_amount
from tillstream.schemas import ORDER_WIDE

# Wide column -> column of the order or of its line.
FROM_ORDER = {
    "order_id": "id",
    "order_status": "order_status",
    "create_time": "create_time",
    "user_id": "user_id",
    "benefit_reduce_amount": "benefit_reduce_amount",
    "original_total_amount": "original_total_amount",
    "feight_fee": "feight_fee",
    "final_total_amount": "final_total_amount",
    "if_first_order": "if_first_order",
    "province_name": "province_name",
    "province_area_code": "province_area_code",
    "user_age_group": "user_age_group",
    "user_gender": "user_gender",
    "dt": "create_date",
}
FROM_LINE = {
    "order_detail_id": "id",
    "sku_id": "sku_id",
    "sku_price": "order_price",
    "sku_num": "sku_num",
    "sku_name": "sku_name",
    "spu_id": "spu_id",
    "tm_id": "tm_id",
    "category3_id": "category3_id",
    "spu_name": "spu_name",
    "tm_name": "tm_name",
    "category3_name": "category3_name",
}


def _side(df: DataFrame, columns: dict[str, str], *extra: Column) -> DataFrame:
    """The wide columns that one side brings; a column it lacks is left for the defaults."""
    have = set(df.columns)
    return df.select(*[F.col(c).alias(w) for w, c in columns.items() if c in have], *extra)


def wide_row(joined: DataFrame, *keep: str) -> DataFrame:
    """All 26 wide columns: absent numbers are 0, absent texts null."""
    have = set(joined.columns)

    def column(field):
        own = F.col(field.name) if field.name in have else F.lit(None)
        if field.dataType.typeName() == "string":
            return own.cast(field.dataType).alias(field.name)
        return F.coalesce(own.cast(field.dataType), F.lit(0).cast(field.dataType)).alias(field.name)

    return joined.select(*[column(f) for f in ORDER_WIDE], *keep)


def batch_number(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(time) / seconds)


def join_orders(
    orders: DataFrame,
    lines: DataFrame,
    order_time: str | None = None,
    line_time: str | None = None,
    window_seconds: int = 6,
    slide_seconds: int = 3,
    delay: str = "10 minutes",
    salts: int = 1,
    repeats: bool = False,
    line_repeats: bool = False,
) -> DataFrame:
    """Wide rows of the orders and lines that share a sliding window.

    A window covers the last ``window_seconds / slide_seconds`` batches of arrival
    time, so a pair meets when its batch numbers differ by less than that. Without
    time columns every order meets all its lines. With them, the line's time stays
    as ``event_time``. On streams the range condition lets Spark drop old state.

    ``salts`` spreads the lines of one order over that many tasks (the order is
    copied to each), for joins that adaptive execution cannot split: streams.

    ``repeats`` is for orders that may have been sent more than once. One copy per
    arrival batch meets the same lines as all of them do, so the others are dropped
    before the join, where many copies of an order would meet many of its lines.
    ``line_repeats`` does the same with the lines: copies of a line are those with its
    id, order and arrival batch. On a stream that costs a narrow row of state for each
    line and saves a wide one for each copy. Lines that were sent at other times stay.
    """
    timed = order_time is not None and line_time is not None
    left = _side(orders, FROM_ORDER, *([F.col(order_time).alias("_order_at")] if timed else []))
    right = _side(
        lines, FROM_LINE, F.col("order_id").alias("_of"), *([F.col(line_time).alias("event_time")] if timed else [])
    )
    if timed and left.isStreaming:
        left = left.withWatermark("_order_at", delay)
    if timed and right.isStreaming:
        right = right.withWatermark("event_time", delay)

    def once(df: DataFrame, keys: list[str], time: str) -> DataFrame:
        columns = df.columns
        if timed:
            df = df.withColumn("_arrival", batch_number(F.col(time), slide_seconds))
            keys = [*keys, "_arrival"]
        df = first_arrived(df, keys, True, salts) if df.isStreaming else first_seen(df, keys, columns)
        return df.select(*columns)

    left = once(left, ["order_id"], "_order_at") if repeats else left
    right = once(right, ["order_detail_id", "_of"], "event_time") if line_repeats else right
    on = F.col("order_id") == F.col("_of")
    if salts > 1:
        left = left.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        right = right.withColumn("_salt", salt_of(right, salts))
        on = on & (F.col("_copy") == F.col("_salt"))
    if timed:
        span = F.expr(f"INTERVAL {window_seconds} SECONDS")
        apart = F.abs(
            batch_number(F.col("_order_at"), slide_seconds) - batch_number(F.col("event_time"), slide_seconds)
        )
        on = (
            on
            & (F.col("event_time") >= F.col("_order_at") - span)
            & (F.col("event_time") <= F.col("_order_at") + span)
            & (apart < window_seconds // slide_seconds)
        )
    if not left.isStreaming:
        # Both sides are facts. The size of a file says little about its rows, so neither is broadcast.
        right = right.hint("merge")
    return wide_row(left.join(right, on), *(["event_time"] if timed else []))


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in ``order``, for tables.

    Spark keeps one row per key in each map task before it shuffles, so copies of
    a hot key do not pile up in one task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def salt_of(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` made from a row's values.

    It must not be random: a task that is run again after a loss would send its rows
    to other tasks than before, and some would be read twice or never.
    """
    return F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")


def first_arrived(df: DataFrame, keys: Sequence[str], within_watermark: bool = True, salts: int = 4) -> DataFrame:
    """The first arrived row of each key, for streams.

    With ``within_watermark`` a key is forgotten after the watermark delay, else
    never. A first pass by key and salt thins out a hot key before the second pass
    by key. The salt comes from all columns, so rows of one key spread when any of
    them differs: a time, or the offset that a message source gives each copy.
    """
    drop = "dropDuplicatesWithinWatermark" if within_watermark else "dropDuplicates"
    if salts > 1:
        salted = df.withColumn("_salt", salt_of(df, salts))
        df = getattr(salted, drop)([*keys, "_salt"]).drop("_salt")
    return getattr(df, drop)(list(keys))


def line_cents(number: str = "sku_num", price: str = "sku_price") -> Column:
    """What a line costs before any reduction."""
    return cents(line_amount(F.col(number), F.col(price)))


def share_cents(as_coded: bool = False) -> Column:
    """One line's share of the paid total, rounded to cents; 0 where the divisor is 0."""
    amount = line_amount(F.col("sku_num"), F.col("sku_price"))
    paid, original = F.col("final_total_amount"), F.col("original_total_amount")
    ratio = F.try_divide(amount, paid) * original if as_coded else F.try_divide(amount, original) * paid
    return F.coalesce(cents(ratio), F.lit(0).cast("bigint"))


def split_amount(
    wide: DataFrame, as_coded: bool = False, prior: DataFrame | None = None, sums_from: DataFrame | None = None
) -> DataFrame:
    """Set ``final_detail_amount``: each line's share of what was paid for its order.

    A share is line amount / original total * paid total, rounded to cents. When
    the lines of an order add up to its original total, the order is complete and
    its line with the highest id (and a price) takes what the others leave over, so
    that the shares add up to the paid total. ``prior`` (order_id, line_cents,
    share_cents) brings the sums of lines seen before ``wide``.

    The sums are plain aggregates over four narrow columns, combined before the
    shuffle, and only the line that gets a correction is joined back, by its own id:
    an order with very many lines needs no single task. Line ids are unique in
    ``wide`` (see ``first_seen``).

    The sums read the rows a second time. Where ``wide`` comes out of lookups that the
    sums do not need, ``sums_from`` gives the same lines without them.

    ``as_coded`` is the formula with the ratio the other way round and without a
    remainder, as the original job computes it.
    """
    shared = wide.withColumn("_share", share_cents(as_coded))
    if as_coded:
        return shared.withColumn("final_detail_amount", F.col("_share") / 100).drop("_share")

    amount = F.col("_amount")
    summed = shared if sums_from is None else sums_from.withColumn("_share", share_cents(as_coded))
    totals = (
        summed.withColumn("_amount", line_cents())
        .groupBy("order_id")
        .agg(
            F.sum(amount).alias("_amount"),
            F.sum("_share").alias("_shared"),
            F.max(F.when(amount != 0, F.col("order_detail_id"))).alias("_priced"),
            F.min("order_detail_id").alias("_lowest"),
            F.max(cents(F.col("original_total_amount"))).alias("_original"),
            F.max(cents(F.col("final_total_amount"))).alias("_paid"),
        )
    )
    before, before_shared = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    if prior is not None:
        seen = prior.select(F.col("order_id").alias("_seen"), "line_cents", "share_cents")
        totals = totals.join(seen, F.col("order_id") == F.col("_seen"), "left")
        before, before_shared = F.col("line_cents"), F.coalesce(F.col("share_cents"), before_shared)
    now = F.coalesce(before, F.lit(0)) + F.col("_amount")
    completed = (now == F.col("_original")) & (before.isNull() | (before != F.col("_original")))
    fixes = (
        totals.where(completed)
        .select(
            F.col("order_id").alias("_order"),
            F.coalesce("_priced", "_lowest").alias("_line"),
            (F.col("_paid") - before_shared - F.col("_shared")).alias("_left"),
        )
        .where(F.col("_left") != 0)
    )
    this_line = (F.col("order_id") == F.col("_order")) & (F.col("order_detail_id") == F.col("_line"))
    return (
        shared.join(fixes, this_line, "left")
        .withColumn("final_detail_amount", (F.col("_share") + F.coalesce(F.col("_left"), F.lit(0))) / 100)
        .drop("_share", "_order", "_line", "_left")
    )


def order_totals(split: DataFrame, prior: DataFrame | None = None, time: str = "event_time") -> DataFrame:
    """Running sums of the orders in ``split``: what ``split_amount`` needs as ``prior`` for later lines."""
    totals = split.groupBy("order_id").agg(
        F.sum(line_cents()).alias("line_cents"),
        F.sum(cents(F.col("final_detail_amount"))).alias("share_cents"),
        F.max(time).alias("last_time"),
    )
    if prior is None:
        return totals
    seen = prior.select(
        F.col("order_id").alias("_seen"), F.col("line_cents").alias("_lines"), F.col("share_cents").alias("_shares")
    )
    return totals.join(seen, F.col("order_id") == F.col("_seen"), "left").select(
        "order_id",
        (F.col("line_cents") + F.coalesce("_lines", F.lit(0))).alias("line_cents"),
        (F.col("share_cents") + F.coalesce("_shares", F.lit(0))).alias("share_cents"),
        "last_time",
    )
