"""Order facts: first-order flag and dimension attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.dims import enrich
from tillstream.operators.dws import first_seen

# An order line without a SKU keeps these numbers at 0.
DETAIL_IDS = ("spu_id", "tm_id", "category3_id")


def flag_first_order(
    orders: DataFrame, user_state: DataFrame | None = None, newcomers: DataFrame | None = None
) -> DataFrame:
    """Set ``if_first_order``: '1' for the earliest order of a user who has not ordered before, else '0'.

    ``user_state`` (user_id, if_consumed) tells who has ordered, or ``newcomers``
    (user_id) who has not; equal times are told apart by the order id. The earliest order is found by an aggregate that
    combines before the shuffle, and comes back by the order id, so that no task
    ever holds all orders of one user. Order ids are unique in ``orders``; see
    ``latest_orders``.
    """
    first = (
        orders.groupBy("user_id")
        .agg(F.min(F.struct("create_time", "id")).alias("_first"))
        .select(F.col("user_id").cast("string").alias("_user"), F.col("_first.id").alias("_id"))
    )
    if user_state is not None:
        known = user_state.where(F.col("if_consumed") == "1").select(F.col("user_id").alias("_known"))
        first = first.join(known, F.col("_user") == F.col("_known"), "left_anti")
    if newcomers is not None:
        new = newcomers.select(F.col("user_id").cast("string").alias("_new"))
        first = first.join(new, F.col("_user") == F.col("_new"), "left_semi")
    flag = F.when(F.col("_id").isNotNull(), "1").otherwise("0")
    return (
        orders.join(first.select("_id"), F.col("id") == F.col("_id"), "left")
        .withColumn("if_first_order", flag)
        .drop("_id")
    )


def latest_orders(orders: DataFrame, version: str) -> DataFrame:
    """One row per order id: that with the greatest ``version``. An order and its changes are one order."""
    return first_seen(orders, ["id"], [F.col(version).desc_nulls_last()])


def user_state_updates(orders: DataFrame) -> DataFrame:
    """State rows of the users whose first order is among ``orders``."""
    return orders.where(F.col("if_first_order") == "1").select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed")
    )


def enrich_order(orders: DataFrame, province: DataFrame | None = None, user: DataFrame | None = None) -> DataFrame:
    """Add the province's names and codes and the user's age group and gender."""
    if province is not None:
        orders = enrich(
            orders,
            province,
            "province_id",
            "id",
            {"province_name": "name", "province_area_code": "area_code", "province_iso_code": "iso_code"},
        )
    if user is not None:
        orders = enrich(
            orders, user, "user_id", "id", {"user_age_group": "user_age_group", "user_gender": "user_gender"}
        )
    return orders


def enrich_detail(detail: DataFrame, sku: DataFrame) -> DataFrame:
    """Add SPU, trademark and category of the line's SKU; without one the ids are 0 and the names null."""
    numbered = sku.withColumns({c: F.col(c).cast("bigint") for c in DETAIL_IDS})
    columns = {c: c for c in ("spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name")}
    found = enrich(detail, numbered, "sku_id", "id", columns)
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in DETAIL_IDS})
