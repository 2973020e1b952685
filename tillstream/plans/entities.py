"""The retail entities, derived from the TPC-H-like test tables.

Everything is computed row by row but for the sums per order, so that the
entities scale like the tables they come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.functions.money import cents
from tillstream.operators.dims import user_info
from tillstream.operators.dwd import enrich_detail, enrich_order, flag_first_order
from tillstream.operators.dws import join_orders, split_amount

AS_OF = "2026-01-01"
# Start of the ten minutes in which the messages arrive (2024-01-01, a whole number of 3 s batches).
ARRIVAL = 1_704_067_200
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
START_EVENTS = ("signup", "view")
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


# Two linear hashes below 2^29 make a line's number; each weight is a random number below its prime.
PRIMES = (536_870_909, 536_870_879)
WEIGHTS = (
    (382_654_169, 97_161_523, 489_135_061, 231_905_113, 518_426_707, 64_309_687, 301_772_441, 443_218_393, 178_530_959),
    (140_277_871, 503_991_347, 27_450_683, 366_128_519, 215_083_661, 478_612_037, 88_904_273, 324_716_209, 411_359_777),
)


def _line_id() -> Column:
    """A 58-bit number made from a line's values; (order, line number) repeats in the test tables."""
    values = [
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "cast(l_linenumber as bigint)",
        "floor(l_quantity * 100D + 0.5D)",
        "floor(l_extendedprice * 100D + 0.5D)",
        "floor(l_discount * 100D + 0.5D)",
        "floor(l_tax * 100D + 0.5D)",
        "cast(unix_date(cast(l_shipdate as date)) as bigint)",
    ]

    def half(prime: int, weights: tuple[int, ...]) -> str:
        terms = " + ".join(f"{value} % {prime} * {weight}" for value, weight in zip(values, weights))
        return f"({terms}) % {prime}"

    return F.expr(f"{half(PRIMES[0], WEIGHTS[0])} * {2**29} + {half(PRIMES[1], WEIGHTS[1])}")


# Schemas of the test tables, read from the files once.
_SCHEMAS: dict[str, StructType] = {}


class Entities:
    """``spread`` is for work that is heavy per row, such as JSON: the rows of a table that comes in fewer parts than
    there are cores are then dealt out to all cores first. A larger one is read by all cores anyway, and is not shuffled."""

    def __init__(self, spark: SparkSession, folder: str, spread: bool = False):
        self.spark, self.folder, self.spread = spark, folder.rstrip("/"), spread

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if self.spread and df.rdd.getNumPartitions() < cores else df

    # Facts as the source database holds them.

    def details(self, replayed: bool = False) -> DataFrame:
        """Order lines. ``replayed`` numbers them by order and line number, which repeats."""
        line = F.col("l_orderkey") * 10 + F.col("l_linenumber") if replayed else _line_id()
        return self.table("lineitem").select(
            line.alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_extendedprice").alias("order_price"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.concat(F.lit("SKU_"), F.col("l_partkey")).alias("sku_name"),
            F.col("l_shipdate").cast("string").alias("create_time"),
            F.timestamp_seconds(F.lit(ARRIVAL) + F.col("l_orderkey") % 600 + F.col("l_linenumber") * 2).alias("arrived"),
        )

    def orders(self, located: bool = True) -> DataFrame:
        """Orders; the original total is the sum over the order's lines. ``located`` looks the province up."""
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("_of"),
            (cents(F.col("l_extendedprice")) * F.col("l_quantity").cast("bigint")).alias("_cents"),
        )
        totals = lines.groupBy("_of").agg((F.sum("_cents") / 100).alias("original_total_amount"))
        joined = self.table("orders").join(totals, F.col("o_orderkey") == F.col("_of"), "left")
        province = F.lit(0).cast("bigint")
        if located:
            nation = F.col("c_nationkey").cast("bigint").alias("_nation")
            customer = self.table("customer").select("c_custkey", nation)
            joined = joined.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            province = F.coalesce("_nation", province)
        created = F.expr("timestampadd(SECOND, cast(o_orderkey * 37 % 86400 as int), o_orderdate)")
        return joined.select(
            F.col("o_orderkey").alias("id"),
            province.alias("province_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_totalprice").alias("final_total_amount"),
            F.lit(0.0).alias("benefit_reduce_amount"),
            F.coalesce("original_total_amount", F.lit(0.0)).alias("original_total_amount"),
            F.lit(0.0).alias("feight_fee"),
            F.lit(None).cast("string").alias("expire_time"),
            created.cast("string").alias("create_time"),
            F.lit(None).cast("string").alias("operate_time"),
            F.substring(created.cast("string"), 1, 10).alias("create_date"),
            F.substring(created.cast("string"), 12, 2).alias("create_hour"),
            F.timestamp_seconds(F.lit(ARRIVAL) + F.col("o_orderkey") % 600).alias("arrived"),
        )

    # Dimensions.

    def trademarks(self) -> DataFrame:
        brand = self.table("part").select("p_brand").distinct()
        return brand.select(_brand_id().alias("tm_id"), F.col("p_brand").alias("tm_name"))

    def categories(self) -> DataFrame:
        kind = self.table("part").select("p_type").distinct()
        return kind.select(_type_id().alias("id"), F.col("p_type").alias("name"), F.lit("1").alias("category2_id"))

    def spus(self) -> DataFrame:
        """SPUs without looked-up names; one is missing its own name."""
        size = F.col("p_size")
        return (
            self.table("part")
            .groupBy("p_size")
            .agg(F.min(_type_id()).alias("category3_id"), F.min(_brand_id()).alias("tm_id"))
            .select(
                size.cast("string").alias("id"),
                F.when(size != 5, F.concat(F.lit("SPU_"), size)).alias("spu_name"),
                F.concat(F.lit("size "), size).alias("description"),
                "category3_id",
                F.lit(None).cast("string").alias("category3_name"),
                "tm_id",
                F.lit("unnamed").alias("tm_name"),
            )
        )

    def bare_skus(self) -> DataFrame:
        """SKUs without looked-up names."""
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("id"),
            F.col("p_name").alias("sku_name"),
            F.col("p_size").cast("string").alias("spu_id"),
            F.lit(None).cast("string").alias("spu_name"),
            _type_id().alias("category3_id"),
            F.lit(None).cast("string").alias("category3_name"),
            _brand_id().alias("tm_id"),
            F.lit("unnamed").alias("tm_name"),
        )

    def skus(self) -> DataFrame:
        """The SKU dimension."""
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("id"),
            F.col("p_name").alias("sku_name"),
            F.col("p_size").cast("string").alias("spu_id"),
            F.concat(F.lit("SPU_"), F.col("p_size")).alias("spu_name"),
            _type_id().alias("category3_id"),
            F.col("p_type").alias("category3_name"),
            _brand_id().alias("tm_id"),
            F.col("p_brand").alias("tm_name"),
        )

    def user_records(self) -> DataFrame:
        born = F.expr("date_add(DATE'1960-01-01', cast(c_custkey * 7919 % 18000 as int))")
        rest = F.col("c_custkey") % 4
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_mktsegment").alias("user_level"),
            born.cast("string").alias("birthday"),
            F.when(rest == 0, "F").when(rest == 1, "M").when(rest == 2, "").alias("gender"),
        )

    def users(self) -> DataFrame:
        return user_info(self.user_records(), F.lit(AS_OF).cast("date"))

    def user_state(self) -> DataFrame:
        """All customers; every third has ordered before."""
        consumed = F.when(F.col("c_custkey") % 3 == 0, "1").otherwise("0").alias("if_consumed")
        return self.table("customer").select(F.col("c_custkey").cast("string").alias("user_id"), consumed)

    def provinces(self) -> DataFrame:
        key = F.col("n_nationkey").cast("string")
        return self.table("nation").select(
            key.alias("id"),
            F.col("n_name").alias("name"),
            F.concat(F.lit("0"), F.col("n_regionkey")).alias("area_code"),
            F.concat(F.lit("N-"), key).alias("iso_code"),
        )

    # The wide fact.

    def wide(
        self,
        sku: bool = False,
        province: bool = False,
        user: bool = False,
        first: bool = False,
        timed: bool = False,
        day: str | None = None,
    ) -> DataFrame:
        """Wide rows with the attributes that are asked for; ``timed`` joins by arrival, ``day`` takes one day's orders."""
        orders, details = self.orders(located=province), self.details()
        if day:
            # An order has one day: the others need not reach the joins and the split.
            orders = orders.where(F.col("create_date") == day)
        if first:
            orders = flag_first_order(orders, self.user_state())
        orders = enrich_order(orders, self.provinces() if province else None, self.users() if user else None)
        if sku:
            details = enrich_detail(details, self.skus())
        times = {"order_time": "arrived", "line_time": "arrived"} if timed else {}
        return join_orders(orders, details, **times)

    def split_wide(self, timed: bool = False, day: str | None = None, **attributes: bool) -> DataFrame:
        """Wide rows with paid shares; the sums over an order's lines need none of the attributes."""
        bare = self.wide(timed=timed, day=day) if any(attributes.values()) else None
        return split_amount(self.wide(timed=timed, day=day, **attributes), sums_from=bare)

    # Messages.

    def logs(self, days: int = 0, kinds: tuple[str, ...] = ()) -> DataFrame:
        """App logs as JSON lines. A log has a filled, a blank, a null or no ``start``.

        ``days`` moves the events in time, ``kinds`` picks event types.
        """
        events = self.table("events")
        events = events.where(F.col("event_type").isin(*kinds)) if kinds else events
        kind = F.col("event_type")
        common = F.to_json(
            F.struct(
                F.concat(F.lit("m"), F.col("user_id")).alias("mid"),
                F.col("user_id").cast("string").alias("uid"),
                kind.alias("ar"),
                F.lit("app").alias("ch"),
                F.lit("v1").alias("vc"),
            )
        )
        start = (
            F.when(kind == "signup", ',"start":{"entry":"icon"}')
            .when(kind == "view", ',"start":"notice"')
            .when(kind == "click", ',"start":" "')
            .when(kind == "error", ',"start":null')
            .otherwise("")
        )
        millis = F.expr(f"timestampdiff(MILLISECOND, {EPOCH}, ts)") + F.lit(days * 86_400_000)
        line = F.concat(F.lit('{"common":'), common, start, F.lit(',"ts":'), millis.cast("string"), F.lit("}"))
        return events.select("event_id", line.alias("value"))

    def startups(self, days: int = 0) -> DataFrame:
        """What the log router sends to the startup topic, with the event's id."""
        return self.logs(days, START_EVENTS)

    def order_messages(self, quoted: bool = False) -> DataFrame:
        """Orders as JSON records; ``quoted`` writes numbers as text. Absent fields are left out."""
        columns = [
            "id",
            "province_id",
            "order_status",
            "user_id",
            "final_total_amount",
            "original_total_amount",
            "create_time",
        ]
        return self.orders().select(_record(columns, quoted).alias("value"))

    def detail_messages(self, quoted: bool = False) -> DataFrame:
        columns = ["id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "create_time"]
        return self.details().select(_record(columns, quoted).alias("value"))

    def changes(self) -> DataFrame:
        """Change records with one object each: two routed tables, one that is not, and empty ones."""

        def change(name: str, rows: DataFrame) -> DataFrame:
            head = F.lit(f'{{"database":"shop","table":"{name}","type":"insert","data":')
            return rows.select(F.concat(head, "value", F.lit("}")).alias("value"))

        users = self.user_records().select(_record(["id", "birthday"], False).alias("value"))
        empty = self.table("orders").select(F.lit("{ }").alias("value"))
        return (
            change("order_info", self.order_messages())
            .union(change("order_detail", self.detail_messages()))
            .union(change("user_info", users))
            .union(change("order_info", empty))
        )

    def array_changes(self) -> DataFrame:
        """Change records with an array: the line before and after its number was doubled, numbers as text."""
        columns = ["id", "order_id", "sku_num"]
        lines = self.details().select("id", "order_id", "sku_num")
        before = _record(columns, True)
        after = F.to_json(
            F.struct(
                F.col("id").cast("string").alias("id"),
                F.col("order_id").cast("string").alias("order_id"),
                (F.col("sku_num") * 2).cast("string").alias("sku_num"),
            )
        )
        return lines.select(
            F.concat(F.lit('{"table":"order_detail","data":['), before, F.lit(","), after, F.lit("]}")).alias("value")
        )


def _brand_id() -> Column:
    return F.regexp_extract("p_brand", r"(\d+)", 1)


def _type_id() -> Column:
    number = F.lit(None).cast("string")
    for i, name in enumerate(PART_TYPES, 1):
        number = F.when(F.col("p_type") == name, str(i)).otherwise(number)
    return number


def _record(columns: list[str], quoted: bool) -> Column:
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) if quoted else F.col(c) for c in columns]))
