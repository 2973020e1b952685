"""Row types of the warehouse layers."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def rows(text: str) -> T.StructType:
    """``"id bigint, name string"`` as a StructType, without a running session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Change records as they arrive from the source database.
ORDER_RECORD = rows(
    "id bigint, province_id bigint, order_status string, user_id bigint, final_total_amount double, "
    "benefit_reduce_amount double, original_total_amount double, feight_fee double, expire_time string, "
    "create_time string, operate_time string"
)
DETAIL_RECORD = rows(
    "id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, sku_name string, create_time string"
)
USER_RECORD = rows("id bigint, user_level string, birthday string, gender string")

# Dimensions.
PROVINCE_INFO = rows("id string, name string, area_code string, iso_code string")
BASE_TRADEMARK = rows("tm_id string, tm_name string")
BASE_CATEGORY3 = rows("id string, name string, category2_id string")
SPU_INFO = rows(
    "id string, spu_name string, description string, category3_id string, category3_name string, "
    "tm_id string, tm_name string"
)
SKU_INFO = rows(
    "id string, sku_name string, spu_id string, spu_name string, category3_id string, category3_name string, "
    "tm_id string, tm_name string"
)
USER_INFO = rows("id bigint, user_level string, user_age int, user_age_group string, user_gender string")
USER_STATE = rows("user_id string, if_consumed string")

# Facts.
ORDER_INFO = T.StructType(
    ORDER_RECORD.fields
    + rows(
        "create_date string, create_hour string, if_first_order string, province_name string, "
        "province_area_code string, province_iso_code string, user_age_group string, user_gender string"
    ).fields
)
ORDER_DETAIL = T.StructType(
    DETAIL_RECORD.fields
    + rows(
        "spu_id bigint, spu_name string, tm_id bigint, tm_name string, category3_id bigint, category3_name string"
    ).fields
)
ORDER_WIDE = rows(
    "order_detail_id bigint, order_id bigint, order_status string, create_time string, user_id bigint, "
    "sku_id bigint, sku_price double, sku_num bigint, sku_name string, benefit_reduce_amount double, "
    "original_total_amount double, feight_fee double, final_total_amount double, final_detail_amount double, "
    "if_first_order string, province_name string, province_area_code string, user_age_group string, "
    "user_gender string, dt string, spu_id bigint, tm_id bigint, category3_id bigint, spu_name string, "
    "tm_name string, category3_name string"
)
DAU_INFO = rows(
    "mid string, uid string, ar string, ch string, vc string, dt string, hr string, mi string, ts bigint"
)
