"""The registered queries as SQL over the test tables.

The SQL takes its own way where there is one: ranks over whole groups for first
rows, running sums for the split, bucket arithmetic for windows.
"""

from __future__ import annotations

from tillstream.operators.ads import STATS
from tillstream.plans.entities import PRIMES, WEIGHTS

LINE_VALUES = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber::BIGINT",
    "CAST(floor(l_quantity * 100 + 0.5) AS BIGINT)",
    "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)",
    "CAST(floor(l_discount * 100 + 0.5) AS BIGINT)",
    "CAST(floor(l_tax * 100 + 0.5) AS BIGINT)",
    "date_diff('day', DATE '1970-01-01', l_shipdate::DATE)",
)


def _hash(prime: int, weights: tuple[int, ...]) -> str:
    return "(" + " + ".join(f"{v} % {prime} * {w}" for v, w in zip(LINE_VALUES, weights)) + f") % {prime}"


LINE_ID = f"({_hash(PRIMES[0], WEIGHTS[0])}) * {2**29} + {_hash(PRIMES[1], WEIGHTS[1])}"

PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "details": (
        (),
        f"""
        SELECT {LINE_ID} AS id,
               l_orderkey * 10 + l_linenumber AS replay_id,
               l_orderkey AS order_id, l_partkey AS sku_id, l_extendedprice AS order_price,
               CAST(l_quantity AS BIGINT) AS sku_num, 'SKU_' || l_partkey AS sku_name,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               1704067200 + l_orderkey % 600 + l_linenumber * 2 AS arrived
        FROM lineitem
        """,
    ),
    "orders0": (
        (),
        """
        SELECT o_orderkey AS id, COALESCE(c_nationkey, 0)::BIGINT AS province_id, o_orderstatus AS order_status,
               o_custkey AS user_id, o_totalprice AS final_total_amount, 0::DOUBLE AS benefit_reduce_amount,
               COALESCE(cents / 100, 0)::DOUBLE AS original_total_amount, 0::DOUBLE AS feight_fee,
               NULL::VARCHAR AS expire_time,
               strftime(o_orderdate + to_seconds(o_orderkey * 37 % 86400), '%Y-%m-%d %H:%M:%S') AS create_time,
               NULL::VARCHAR AS operate_time, 1704067200 + o_orderkey % 600 AS arrived
        FROM orders
        LEFT JOIN (SELECT l_orderkey,
                          SUM(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * CAST(l_quantity AS BIGINT)) AS cents
                   FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
        LEFT JOIN customer ON c_custkey = o_custkey
        """,
    ),
    "order_facts": (
        ("orders0",),
        "SELECT *, substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour FROM orders0",
    ),
    "brands": (
        (),
        "SELECT DISTINCT regexp_extract(p_brand, '\\d+') AS tm_id, p_brand AS tm_name FROM part",
    ),
    "parts": (
        (),
        """
        SELECT *, regexp_extract(p_brand, '\\d+') AS brand_id,
               CASE p_type WHEN 'ECONOMY' THEN '1' WHEN 'LARGE' THEN '2' WHEN 'MEDIUM' THEN '3'
                           WHEN 'PROMO' THEN '4' WHEN 'SMALL' THEN '5' WHEN 'STANDARD' THEN '6' END AS type_id
        FROM part
        """,
    ),
    "kinds": (("parts",), "SELECT DISTINCT type_id AS id, p_type AS name FROM parts"),
    "spus": (
        ("parts",),
        """
        SELECT p_size::VARCHAR AS id, CASE WHEN p_size <> 5 THEN 'SPU_' || p_size END AS spu_name,
               'size ' || p_size AS description, MIN(type_id) AS category3_id, MIN(brand_id) AS tm_id
        FROM parts GROUP BY p_size
        """,
    ),
    "skus": (
        ("parts",),
        """
        SELECT p_partkey, p_partkey::VARCHAR AS id, p_name AS sku_name, p_size AS spu_id, 'SPU_' || p_size AS spu_name,
               type_id::BIGINT AS category3_id, p_type AS category3_name, brand_id::BIGINT AS tm_id, p_brand AS tm_name
        FROM parts
        """,
    ),
    "user_records": (
        (),
        """
        SELECT c_custkey AS id, c_mktsegment AS user_level,
               DATE '1960-01-01' + CAST(c_custkey * 7919 % 18000 AS INTEGER) AS born,
               CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN '' END AS gender
        FROM customer
        """,
    ),
    "users": (
        ("user_records",),
        """
        SELECT id, user_level, age AS user_age,
               CASE WHEN age < 20 THEN '20岁以下' WHEN age < 30 THEN '20岁到30岁' ELSE '30岁以上' END AS user_age_group,
               CASE gender WHEN 'F' THEN '女' WHEN 'M' THEN '男' ELSE '保密' END AS user_gender
        FROM (SELECT *, CAST(date_diff('day', born, DATE '2026-01-01') // 365 AS INTEGER) AS age FROM user_records)
        """,
    ),
    "provinces": (
        (),
        """
        SELECT n_nationkey AS id, n_name AS name, '0' || n_regionkey AS area_code, 'N-' || n_nationkey AS iso_code
        FROM nation
        """,
    ),
    "known": ((), "SELECT c_custkey AS user_id FROM customer WHERE c_custkey % 3 = 0"),
    "flagged": (
        ("order_facts", "known"),
        """
        SELECT o.*, CASE WHEN k.user_id IS NULL
                          AND row_number() OVER (PARTITION BY o.user_id ORDER BY o.create_time, o.id) = 1
                         THEN '1' ELSE '0' END AS if_first_order
        FROM order_facts o LEFT JOIN known k ON k.user_id = o.user_id
        """,
    ),
    "rich_orders": (
        ("flagged", "provinces", "users"),
        """
        SELECT o.*, p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
               u.user_age_group, u.user_gender
        FROM flagged o LEFT JOIN provinces p ON p.id = o.province_id LEFT JOIN users u ON u.id = o.user_id
        """,
    ),
    "rich_details": (
        ("details", "skus"),
        """
        SELECT d.*, COALESCE(s.spu_id, 0)::BIGINT AS spu_id, s.spu_name, COALESCE(s.tm_id, 0) AS tm_id, s.tm_name,
               COALESCE(s.category3_id, 0) AS category3_id, s.category3_name
        FROM details d LEFT JOIN skus s ON s.p_partkey = d.sku_id
        """,
    ),
    "wide": (
        ("rich_orders", "rich_details"),
        """
        SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
               d.order_price AS sku_price, d.sku_num, d.sku_name, o.benefit_reduce_amount, o.original_total_amount,
               o.feight_fee, o.final_total_amount, 0::DOUBLE AS final_detail_amount, o.if_first_order,
               o.province_name, o.province_area_code, o.user_age_group, o.user_gender, o.create_date AS dt,
               d.spu_id, d.tm_id, d.category3_id, d.spu_name, d.tm_name, d.category3_name,
               o.arrived AS order_arrived, d.arrived AS event_time, d.replay_id
        FROM rich_orders o JOIN rich_details d ON d.order_id = o.id
        """,
    ),
    "met": (
        ("wide",),
        "SELECT * FROM wide WHERE abs(order_arrived // 3 - event_time // 3) <= 1",
    ),
    "events_in": (
        (),
        """
        SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms, 'm' || user_id AS mid, user_id::VARCHAR AS uid,
               strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr
        FROM events
        """,
    ),
    "dau": (
        ("events_in",),
        """
        SELECT mid, uid, event_type AS ar, 'app' AS ch, 'v1' AS vc, dt, hr, '00' AS mi, ms AS ts
        FROM events_in WHERE event_type IN ('signup', 'view')
        QUALIFY row_number() OVER (PARTITION BY dt, mid ORDER BY ms, event_id) = 1
        """,
    ),
}


def _split(name: str, source: str, order: str = "order_detail_id") -> tuple[str, tuple[tuple[str, ...], str]]:
    """Shares by running sums: the line at which an order reaches its original total takes the rest."""
    body = f"""
        SELECT * EXCLUDE (share, line, before, shared),
               CASE WHEN before + line = original AND (before <> original OR first_line)
                    THEN paid - shared ELSE share END / 100 AS amount
        FROM (
          SELECT *, COALESCE(SUM(line) OVER w, 0) AS before, COALESCE(SUM(share) OVER w, 0) AS shared,
                 row_number() OVER (PARTITION BY order_id ORDER BY {order}) = 1 AS first_line
          FROM (
            SELECT * EXCLUDE (final_detail_amount), CAST(floor(sku_num * sku_price * 100 + 0.5) AS BIGINT) AS line,
                   CAST(floor(original_total_amount * 100 + 0.5) AS BIGINT) AS original,
                   CAST(floor(final_total_amount * 100 + 0.5) AS BIGINT) AS paid,
                   CAST(floor(sku_num * sku_price / original_total_amount * final_total_amount * 100 + 0.5) AS BIGINT)
                     AS share
            FROM {source}
          )
          WINDOW w AS (PARTITION BY order_id ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        )
        """
    return name, ((source,), body)


PARTS.update(
    [
        _split("shares", "wide"),
        _split("met_shares", "met"),
        _split("shares_by_batch", "wide", "order_detail_id % 2, order_detail_id"),
    ]
)


def _sql(body: str, *parts: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in PARTS[name][0]:
                need(other)
            order.append(name)

    for part in parts:
        need(part)
    head = ",\n".join(f"{name} AS ({PARTS[name][1].strip()})" for name in order)
    return f"WITH {head}\n{body.strip()}" if head else body.strip()


def _money(column: str) -> str:
    return f"SUM(CAST({column} AS DECIMAL(18,2)))"


ORDER_FIELDS = (
    "id, province_id, order_status, user_id, final_total_amount, benefit_reduce_amount, original_total_amount, "
    "feight_fee, expire_time, create_time, operate_time"
)
DETAIL_FIELDS = "id, order_id, sku_id, order_price, sku_num, sku_name, create_time"
SKU_NAMES = """
    SELECT p.p_partkey::VARCHAR AS id, p.p_name AS sku_name, p.p_size::VARCHAR AS spu_id, s.spu_name,
           p.type_id AS category3_id, k.name AS category3_name, p.brand_id AS tm_id,
           COALESCE(b.tm_name, 'unnamed') AS tm_name
    FROM parts p LEFT JOIN spus s ON s.id = {key} LEFT JOIN brands b ON b.tm_id = p.brand_id
    LEFT JOIN kinds k ON k.id = p.type_id
"""
WIDE_FIELDS = "* EXCLUDE (order_arrived, event_time, replay_id)"

ORACLE: dict[str, str] = {
    "route_logs": _sql(
        """
        SELECT CASE WHEN event_type IN ('signup', 'view') THEN 'STARTUP_LOG' ELSE 'EVENT_LOG' END AS topic,
               mid, event_type AS ar, ms AS ts FROM events_in
        """,
        "events_in",
    ),
    "route_maxwell": _sql(
        """
        SELECT 'ODS_ORDER_INFO' AS topic, id, create_time,
               CAST(floor(final_total_amount * 100 + 0.5) AS BIGINT) AS paid_cents FROM order_facts
        UNION ALL SELECT 'ODS_ORDER_DETAIL', id, create_time, NULL FROM details
        """,
        "order_facts",
        "details",
    ),
    "route_canal": _sql(
        """
        SELECT 'ODS_ORDER_DETAIL' AS topic,
               '{"id":"' || id || '","order_id":"' || order_id || '","sku_num":"' || (sku_num * times) || '"}' AS value
        FROM details, (VALUES (1), (2)) t(times)
        """,
        "details",
    ),
    "parse_orders": _sql(f"SELECT {ORDER_FIELDS}, create_date, create_hour FROM order_facts", "order_facts"),
    "parse_details": _sql(f"SELECT {DETAIL_FIELDS} FROM details", "details"),
    "to_messages": _sql(
        """
        SELECT 'DWD_ORDER_INFO' AS topic, id::VARCHAR AS key,
               '{"id":' || id || ',"province_id":' || province_id || ',"order_status":"' || order_status
               || '","user_id":' || user_id || ',"create_time":"' || create_time || '"}' AS value
        FROM order_facts
        """,
        "order_facts",
    ),
    "fan_out": _sql(
        """
        SELECT topic, id::VARCHAR AS key, '{"id":' || id || ',"order_status":"' || order_status || '"}' AS value
        FROM order_facts, (VALUES ('DWD_ORDER_WIDE_TM'), ('DWD_ORDER_WIDE_SPU'), ('DWD_ORDER_WIDE_CATE'),
                                  ('DWD_ORDER_WIDE_SEX'), ('DWD_ORDER_WIDE_AGE'), ('DWD_ORDER_WIDE_PROVINCE')) t(topic)
        """,
        "order_facts",
    ),
    "user_info": _sql("SELECT id, user_level, user_age, user_age_group, user_gender FROM users", "users"),
    "diff_ms": _sql(
        "SELECT id, date_diff('day', born, DATE '2026-01-01') * 86400000 AS lived_ms FROM user_records", "user_records"
    ),
    "spu_info": _sql(
        """
        SELECT s.id, s.spu_name, s.description, s.category3_id, k.name AS category3_name, s.tm_id,
               COALESCE(b.tm_name, 'unnamed') AS tm_name
        FROM spus s LEFT JOIN brands b ON b.tm_id = s.tm_id LEFT JOIN kinds k ON k.id = s.category3_id
        """,
        "spus",
        "brands",
        "kinds",
    ),
    "sku_info": _sql(SKU_NAMES.format(key="p.p_size::VARCHAR"), "parts", "spus", "brands", "kinds"),
    "sku_info_as_coded": _sql(SKU_NAMES.format(key="p.brand_id"), "parts", "spus", "brands", "kinds"),
    "reduce_dim": _sql(
        "SELECT id, spu_name, tm_name FROM skus WHERE p_partkey IN (SELECT l_partkey FROM lineitem)", "skus"
    ),
    "upsert_latest": _sql(
        """
        SELECT id, status, changed, seq FROM (
          SELECT o_orderkey AS id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS changed,
                 0::BIGINT AS seq, 0 AS new FROM orders
          UNION ALL SELECT order_id, sku_name, create_time, id, 1 FROM details)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY changed DESC, seq DESC, new DESC) = 1
        """,
        "details",
    ),
    "keyed_table": _sql(
        """
        SELECT id, CASE WHEN id % 3 = 0 THEN 'sent' WHEN id % 2 = 0 THEN 'paid' ELSE order_status END AS order_status,
               create_time FROM order_facts
        """,
        "order_facts",
    ),
    "read_dim": "SELECT p_partkey, p_name FROM part WHERE p_size IN (1, 5, 9)",
    "order_detail_enriched": _sql("SELECT * EXCLUDE (replay_id, arrived) FROM rich_details", "rich_details"),
    "lookup_miss": _sql(
        """
        SELECT d.* EXCLUDE (replay_id, arrived, sku_id), CASE WHEN d.sku_num > 5 THEN d.sku_id ELSE -1 - d.sku_id END AS sku_id,
               COALESCE(s.spu_id, 0)::BIGINT AS spu_id, s.spu_name, COALESCE(s.tm_id, 0) AS tm_id, s.tm_name,
               COALESCE(s.category3_id, 0) AS category3_id, s.category3_name
        FROM details d LEFT JOIN skus s ON s.p_partkey = d.sku_id AND d.sku_num > 5
        """,
        "details",
        "skus",
    ),
    "first_order_flag": _sql(
        """
        SELECT id, user_id, create_time, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                                              THEN '1' ELSE '0' END AS if_first_order FROM order_facts
        """,
        "order_facts",
    ),
    "first_order_over_batches": _sql(
        """
        SELECT id, user_id, create_time,
               CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY id % 2, create_time, id) = 1
                    THEN '1' ELSE '0' END AS if_first_order
        FROM order_facts
        """,
        "order_facts",
    ),
    "first_order_with_state": _sql("SELECT id, user_id, create_time, if_first_order FROM flagged", "flagged"),
    "user_state_updates": _sql(
        "SELECT user_id::VARCHAR AS user_id, '1' AS if_consumed FROM flagged WHERE if_first_order = '1'", "flagged"
    ),
    "order_info_enriched": _sql(
        f"""
        SELECT {ORDER_FIELDS}, create_date, create_hour, if_first_order, province_name, province_area_code,
               province_iso_code, user_age_group, user_gender FROM rich_orders
        """,
        "rich_orders",
    ),
    "order_wide": _sql(f"SELECT {WIDE_FIELDS} FROM wide", "wide"),
    "order_join_batches": _sql(
        """
        SELECT replay_id AS order_detail_id, order_id, user_id, sku_id, sku_price, sku_num, dt FROM met
        QUALIFY row_number() OVER (PARTITION BY replay_id ORDER BY event_time, sku_id, sku_price, sku_num) = 1
        """,
        "met",
    ),
    "order_join_salted": _sql(
        "SELECT order_detail_id, order_id, user_id, sku_id, sku_price, sku_num, dt FROM met", "met"
    ),
    "split_amount": _sql(
        "SELECT order_id, order_detail_id, amount AS final_detail_amount FROM shares", "shares"
    ),
    "split_amount_as_coded": _sql(
        """
        SELECT order_id, order_detail_id,
               CAST(floor(sku_num * sku_price / final_total_amount * original_total_amount * 100 + 0.5) AS BIGINT) / 100
                 AS final_detail_amount
        FROM wide
        """,
        "wide",
    ),
    "split_amount_partial": _sql(
        "SELECT order_id, order_detail_id, amount AS final_detail_amount FROM met_shares", "met_shares"
    ),
    "split_amount_two_batches": _sql(
        "SELECT order_id, order_detail_id, amount AS final_detail_amount FROM shares_by_batch", "shares_by_batch"
    ),
    "sliding_amount": _sql(
        f"""
        SELECT (event_time // 3 - back) * 3 AS window_start, tm_id, {_money("amount")}::DOUBLE AS amount
        FROM met_shares, (VALUES (0), (1)) t(back) GROUP BY ALL
        """,
        "met_shares",
    ),
    "stat_windowed": _sql(
        f"""
        SELECT event_time // 3 * 3 AS window_start, province_name, {_money("amount")}::DOUBLE AS amount
        FROM met_shares GROUP BY ALL
        """,
        "met_shares",
    ),
    "dau_document": _sql(
        """
        SELECT mid, uid, event_type AS ar, 'app' AS ch, 'v1' AS vc, dt, hr, '00' AS mi, ms AS ts
        FROM events_in WHERE event_type IN ('signup', 'view')
        """,
        "events_in",
    ),
    "dau_first_seen": _sql("SELECT * FROM dau", "dau"),
    "dau_total": _sql("SELECT COUNT(*) AS total FROM dau WHERE dt = '2024-01-15'", "dau"),
    "dau_hour": _sql(
        "SELECT hr, COUNT(*) AS total FROM dau WHERE dt = '2024-01-15' GROUP BY hr ORDER BY total DESC, hr LIMIT 24", "dau"
    ),
    "order_amount": _sql(
        f"SELECT COALESCE({_money('amount')}, 0)::DOUBLE AS order_amount FROM shares WHERE dt = '1998-01-15'", "shares"
    ),
    "order_amount_hour": _sql(
        f"""
        SELECT CAST(CAST(substr(create_time, 12, 2) AS INTEGER) AS VARCHAR) AS hr,
               {_money("amount")}::DOUBLE AS order_amount
        FROM shares WHERE dt = '1998-01-15' GROUP BY ALL
        """,
        "shares",
    ),
    "realtime_total": _sql(
        f"""
        SELECT 'dau' AS id, '新增日活' AS name, COUNT(*)::VARCHAR AS value FROM dau
        WHERE strftime(CAST(dt AS DATE) - 9496, '%Y-%m-%d') = '1998-01-15'
        UNION ALL
        SELECT 'order_amount', '订单金额', CAST(COALESCE({_money("amount")}, 0) AS DECIMAL(38,2))::VARCHAR
        FROM shares WHERE dt = '1998-01-15'
        """,
        "dau",
        "shares",
    ),
    "append_daily": _sql("SELECT dt, COUNT(*) AS total FROM dau GROUP BY dt", "dau"),
    "stream_wide": _sql(
        f"SELECT order_id, COUNT(*) AS lines, {_money('amount')}::DOUBLE AS paid FROM met_shares GROUP BY order_id",
        "met_shares",
    ),
    "stored_day_reports": _sql(
        f"""
        SELECT dt, COUNT(*) AS lines, {_money('amount')}::DOUBLE AS order_amount
        FROM met_shares WHERE dt IN (SELECT create_date FROM order_facts) GROUP BY dt
        """,
        "met_shares",
        "order_facts",
    ),
    "as_of_lookup": _sql(
        """
        SELECT d.id, d.sku_id, d.sku_num, d.arrived, v.sku_name FROM details d
        ASOF LEFT JOIN (
          SELECT p_partkey AS id, 1704067200 AS since, p_name || ' v1' AS sku_name FROM part WHERE p_partkey % 3 <> 0
          UNION ALL SELECT p_partkey, 1704067200 + p_partkey % 300 + 1, p_name || ' v2' FROM part
          UNION ALL SELECT p_partkey, 1704067200 + p_partkey % 300 + 300, p_name || ' v3' FROM part
        ) v ON v.id = d.sku_id AND d.arrived >= v.since
        """,
        "details",
    ),
    "stat_clock": _sql(
        f"""
        SELECT user_gender AS key, {_money('amount')}::DOUBLE AS amount, TRUE AS well_formed, TRUE AS is_now
        FROM shares GROUP BY user_gender
        """,
        "shares",
    ),
    "stream_dau": _sql("SELECT dt, mid, uid FROM dau", "dau"),
    "resume": _sql("SELECT dt, mid, uid FROM dau", "dau"),
    "stream_stat_windowed": _sql(
        f"""
        SELECT event_time // 3 * 3 AS window_start, province_name, {_money("final_total_amount")}::DOUBLE AS amount
        FROM met GROUP BY ALL
        """,
        "met",
    ),
    "stream_first_order": _sql(
        """
        SELECT o.user_id, u.user_gender, u.user_age_group, COUNT(*) AS orders, 1::BIGINT AS first_orders
        FROM order_facts o LEFT JOIN users u ON u.id = o.user_id GROUP BY ALL
        """,
        "order_facts",
        "users",
    ),
    "stream_known_users": _sql(
        """
        SELECT o.user_id, u.user_gender, u.user_age_group, COUNT(*) AS orders,
               CASE WHEN o.user_id % 3 = 0 THEN 0 ELSE 1 END::BIGINT AS first_orders
        FROM order_facts o LEFT JOIN users u ON u.id = o.user_id GROUP BY ALL
        """,
        "order_facts",
        "users",
    ),
    "stream_details": _sql("SELECT * EXCLUDE (replay_id, arrived) FROM rich_details", "rich_details"),
    "stream_dims": _sql(SKU_NAMES.format(key="p.p_size::VARCHAR"), "parts", "spus", "brands", "kinds"),
    "message_round_trip": _sql(
        f"SELECT id::VARCHAR AS key, 'DWD_ORDER_DETAIL' AS topic, {DETAIL_FIELDS} FROM details", "details"
    ),
}

_CATEGORY_TOTALS = _sql(
    f"""
    SELECT category3_id::VARCHAR AS id, category3_name AS name, {_money("final_total_amount")}::DOUBLE AS amount
    FROM wide GROUP BY ALL
    """,
    "wide",
)
ORACLE["append_exactly_once"] = _CATEGORY_TOTALS
ORACLE["stream_stats"] = _CATEGORY_TOTALS
ORACLE["stream_replayed_stats"] = _CATEGORY_TOTALS

for _name, _stat in STATS.items():
    _keys = ", ".join(f"{column}::VARCHAR AS {name}" for name, column in _stat.by.items())
    _head = f"SELECT '2026-01-01 00:00:00' AS stat_time, {_keys}"
    ORACLE[f"stat_{_name}"] = _sql(f"{_head}, {_money('amount')}::DOUBLE AS amount FROM shares GROUP BY ALL", "shares")
    if _stat.as_coded != "final_detail_amount":
        ORACLE[f"stat_{_name}_as_coded"] = _sql(
            f"{_head}, {_money(_stat.as_coded)}::DOUBLE AS amount FROM wide GROUP BY ALL", "wide"
        )

# Statistic, its id and its name, in the SQL of all of them.
_ALL = (
    ("trademark", "tm_id", "tm_name"),
    ("category", "category3_id", "category3_name"),
    ("spu", "spu_id", "spu_name"),
    ("province", "province_area_code", "province_name"),
    ("gender", "user_gender", "NULL"),
    ("age", "user_age_group", "NULL"),
)


def _all_stats(measure: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '2026-01-01 00:00:00' AS stat_time, '{stat}' AS stat, {key}::VARCHAR AS id, {name}::VARCHAR AS name, "
        f"{_money('amount' if stat == 'trademark' else measure)}::DOUBLE AS amount FROM shares GROUP BY ALL"
        for stat, key, name in _ALL
    )


ORACLE["stat_all"] = _sql(_all_stats("amount"), "shares")
ORACLE["stat_all_as_coded"] = _sql(_all_stats("final_total_amount"), "shares")
