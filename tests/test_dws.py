import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.dws import first_seen, join_orders, order_totals, salt_of, split_amount, wide_row

LINES = (
    "order_detail_id bigint, order_id bigint, sku_num bigint, sku_price double, "
    "original_total_amount double, final_total_amount double, event_time timestamp"
)


def lines(spark, *rows):
    """Rows of (line, order, number, price, original, paid)."""
    df = spark.createDataFrame([(*r, None) for r in rows], LINES)
    return df.withColumn("event_time", F.timestamp_seconds(F.lit(1000)))


def shares(df):
    return {r.order_detail_id: r.final_detail_amount for r in df.collect()}


def half_up(x):
    return math.floor(x * 100 + 0.5)


def fold(rows, state=None):
    """The rule line by line in the order of arrival: {line: cents}, {order: (lines, shares)}."""
    out, state = {}, dict(state or {})
    for line, order, number, price, original, paid in rows:
        before, shared, closed = state.get(order, (0, 0, False))
        amount = half_up(number * price)
        if not closed and before + amount == half_up(original):
            out[line], closed = half_up(paid) - shared, True
        else:
            out[line] = half_up(number * price / original * paid) if original else 0
        state[order] = (before + amount, shared + out[line], closed)
    return out, state


def test_three_lines_share_twenty(spark):
    rows = [(i, 1, 1, 10.0, 30.0, 20.0) for i in (3, 1, 2)]
    assert shares(split_amount(lines(spark, *rows))) == {1: 6.67, 2: 6.67, 3: 6.66}


def test_one_line_takes_all(spark):
    assert shares(split_amount(lines(spark, (1, 1, 3, 3.33, 9.99, 7.77)))) == {1: 7.77}


def test_missing_line_leaves_no_remainder(spark):
    rows = [(i, 1, 1, 10.0, 30.0, 20.0) for i in (1, 2)]
    assert shares(split_amount(lines(spark, *rows))) == {1: 6.67, 2: 6.67}


def test_a_free_last_line_takes_nothing(spark):
    rows = [(1, 1, 1, 10.0, 30.0, 20.0), (2, 1, 1, 20.0, 30.0, 20.0), (3, 1, 1, 0.0, 30.0, 20.0)]
    assert shares(split_amount(lines(spark, *rows))) == {1: 6.67, 2: 13.33, 3: 0.0}


def test_zero_totals(spark):
    free = [(1, 1, 1, 0.0, 0.0, 5.0), (2, 1, 1, 0.0, 0.0, 5.0)]
    unpaid = [(3, 2, 1, 5.0, 5.0, 0.0)]
    assert shares(split_amount(lines(spark, *free, *unpaid))) == {1: 5.0, 2: 0.0, 3: 0.0}


def test_as_coded_turns_the_ratio_over_and_leaves_no_remainder(spark):
    rows = [(i, 1, 1, 10.0, 30.0, 20.0) for i in (1, 2, 3)] + [(4, 2, 1, 5.0, 5.0, 0.0)]
    assert shares(split_amount(lines(spark, *rows), as_coded=True)) == {1: 15.0, 2: 15.0, 3: 15.0, 4: 0.0}


def test_later_lines_use_the_sums_of_earlier_ones(spark):
    one = lines(spark, (5, 1, 1, 10.0, 30.0, 20.0), (6, 2, 1, 1.0, 1.0, 1.0))
    first = split_amount(one)
    prior = order_totals(first)
    assert {r.order_id: (r.line_cents, r.share_cents) for r in prior.collect()} == {1: (1000, 667), 2: (100, 100)}
    second = split_amount(lines(spark, (2, 1, 1, 10.0, 30.0, 20.0), (1, 1, 1, 10.0, 30.0, 20.0)), prior=prior)
    assert shares(second) == {1: 6.67, 2: 6.66}
    after = order_totals(second, prior)
    assert {r.order_id: (r.line_cents, r.share_cents) for r in after.collect()} == {1: (3000, 2000)}
    # The order is complete: a late free line gets nothing.
    assert shares(split_amount(lines(spark, (9, 1, 1, 0.0, 30.0, 20.0)), prior=after)) == {9: 0.0}


orders_strategy = st.lists(
    st.tuples(
        st.lists(st.tuples(st.integers(1, 9), st.integers(0, 5000)), min_size=1, max_size=7),  # number, price in cents
        st.integers(0, 90_000),  # paid
        st.booleans(),  # one line is missing
    ),
    min_size=5,
    max_size=30,
)


@settings(max_examples=6, deadline=None)
@given(orders_strategy, st.integers(1, 3))
def test_split_follows_the_rule_line_by_line(spark, orders, batches):
    rows, line = [], 0
    for order, (items, paid, missing) in enumerate(orders):
        original = sum(n * p for n, p in items) / 100
        for n, p in items[1:] if missing else items:
            line += 1
            rows.append((line, order, n, p / 100, original, paid / 100))
    state, prior, got, want = None, None, {}, {}
    for b in range(batches):
        part = [r for i, r in enumerate(rows) if i * batches // max(len(rows), 1) == b]
        if not part:
            continue
        out, state = fold(part, state)
        want.update(out)
        split = split_amount(lines(spark, *part), prior=prior)
        got.update({k: half_up(v) for k, v in shares(split).items()})
        known = order_totals(split, prior)
        if prior is not None:
            known = known.unionByName(prior.join(known, "order_id", "left_anti"))
        prior = spark.createDataFrame(known.collect(), known.schema)
    assert got == want
    for order, (items, paid, missing) in enumerate(orders):
        if not missing:
            assert sum(c for r, c in ((r, got[r[0]]) for r in rows) if r[1] == order) == paid


def test_split_needs_no_window(spark, plan):
    """A window over an order would put all its lines into one task."""
    text = plan(split_amount(lines(spark, (1, 1, 1, 1.0, 1.0, 1.0))))
    assert "Window" not in text and "partial_sum" in text


def test_a_hot_order_is_split_over_tasks(spark, plan):
    """A third of all lines belongs to one order."""
    settings_ = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        n = 60_000
        detail = spark.range(0, n, 1, 16).select(
            "id",
            F.when(F.col("id") < n // 3, -1).otherwise(F.col("id") % 5000).alias("order_id"),
            F.lit(1).cast("bigint").alias("sku_num"),
            F.lit(1.0).alias("order_price"),
        )
        original = F.when(F.col("id") == -1, n / 3).otherwise(8.0)
        orders = spark.range(-1, 5000).select(
            "id", original.alias("original_total_amount"), (original - 0.5).alias("final_total_amount")
        )
        split = split_amount(join_orders(orders, detail)).select("order_id", "order_detail_id", "final_detail_amount")
        assert "skew=true" in plan(split, run=True)
        hot = split.where("order_id = -1").agg(F.count("*"), F.sum(F.col("final_detail_amount").cast("decimal(18,2)")))
        assert [float(x) for x in hot.collect()[0]] == [n / 3, n / 3 - 0.5]
        assert split.count() == n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


ORDER_SIDE = "id bigint, at timestamp"
LINE_SIDE = "id bigint, order_id bigint, at timestamp"


def timed(spark, schema, *rows):
    df = spark.createDataFrame([(*r[:-1], None) for r in rows], schema)
    names = [c for c in df.columns if c != "at"]
    seconds = {r[0]: r[-1] for r in rows}
    at = F.create_map(*[F.lit(x) for pair in seconds.items() for x in pair])[F.col("id")]
    return df.select(*names, F.timestamp_seconds(at).alias("at"))


@pytest.mark.parametrize("salts", [1, 3])
def test_pairs_meet_when_their_batches_share_a_window(spark, salts):
    orders = timed(spark, ORDER_SIDE, *[(i, 300 + i) for i in range(12)])
    wanted, details = set(), []
    for i in range(12):
        for j in range(12):
            details.append((i * 100 + j, i, 300 + j))
            if abs((300 + i) // 3 - (300 + j) // 3) <= 1:
                wanted.add((i, i * 100 + j))
    joined = join_orders(orders, timed(spark, LINE_SIDE, *details), "at", "at", salts=salts)
    assert sorted((r.order_id, r.order_detail_id) for r in joined.collect()) == sorted(wanted)


def test_repeated_orders_meet_their_lines_once_per_batch(spark):
    """Copies in one batch of arrival are one; a copy in a later batch still meets later lines."""
    orders = timed(spark, ORDER_SIDE, (1, 300)).union(timed(spark, ORDER_SIDE, (1, 301)))
    orders = orders.union(orders).union(timed(spark, ORDER_SIDE, (1, 330)))
    details = timed(spark, LINE_SIDE, (10, 1, 302), (11, 1, 331), (12, 1, 315))
    joined = join_orders(orders, details, "at", "at", repeats=True)
    assert sorted(r.order_detail_id for r in joined.collect()) == [10, 11]


def test_salts_repeat_and_spread(spark):
    df = spark.range(10_000).select("id", F.lit(7).alias("order_id"))
    salted = df.select(salt_of(df, 4).alias("s"))
    assert salted.exceptAll(df.repartition(13).select(salt_of(df, 4).alias("s"))).isEmpty()
    assert min(r["count"] for r in salted.groupBy("s").count().collect()) > 2000


def test_without_times_every_line_meets_its_order(spark):
    orders, details = spark.range(3), spark.createDataFrame([(7, 1), (8, 1), (9, 5)], "id bigint, order_id bigint")
    assert sorted(r.order_detail_id for r in join_orders(orders, details).collect()) == [7, 8]


def test_wide_row_has_all_columns_and_defaults(spark):
    row = wide_row(spark.createDataFrame([(1, None, "x")], "order_id bigint, sku_num bigint, dt string")).collect()[0]
    assert list(row.asDict()) == schemas.ORDER_WIDE.names and len(row) == 26
    assert (row.order_id, row.sku_num, row.dt, row.spu_id, row.spu_name, row.sku_price) == (1, 0, "x", 0, None, 0.0)


def test_first_seen_keeps_one_row_per_key_and_task(spark, plan):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, "c"), (1, 3, "z")], "k int, t int, v string")
    first = first_seen(df, ["k"], ["t", "v"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, 3, "a"), (2, 9, "c")]
    assert "WindowGroupLimit" in plan(first) and "Partial" in plan(first)
