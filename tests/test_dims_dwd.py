import datetime as dt

from pyspark.sql import functions as F

from tillstream.operators.dims import as_of_lookup, enrich, reduce_dim, sku_info, spu_info, user_info
from tillstream.operators.dwd import enrich_detail, enrich_order, flag_first_order, user_state_updates

NAME = {"name": "n"}


def test_enrich_hit_miss_and_null(table, rows):
    facts = table("k bigint, name string", (1, "own"), (2, "own"), (3, "own"), (None, "own"))
    dim = table("id string, n string", ("1", "a"), ("2", None), ("x", "z"), (None, "null"))
    assert rows(enrich(facts, dim, "k", "id", NAME)) == [(1, "a"), (2, None), (3, "own"), (None, "own")]
    kept = enrich(facts, dim, "k", "id", NAME, keep_if_null=True)
    assert rows(kept) == [(1, "a"), (2, "own"), (3, "own"), (None, "own")]


def test_enrich_adds_columns_that_are_not_there(table):
    out = enrich(table("k string", ("a",), ("b",)), table("id string, n string", ("a", "A")), "k", "id", NAME)
    assert out.columns == ["k", "name"]
    assert {r.k: r.name for r in out.collect()} == {"a": "A", "b": None}


def test_enrich_leaves_the_join_choice_to_size(spark, table, plan):
    facts = spark.range(10).withColumnRenamed("id", "k")
    dim = table("id string, n string", ("1", "a"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in plan(enrich(facts, dim, "k", "id", NAME))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_reduce_dim(table, rows):
    dim = table("id string, n string", ("1", "a"), ("2", "b"), ("z", "c"))
    facts = table("k bigint", (2,), (2,), (9,), (None,))
    assert rows(reduce_dim(dim, facts, "id", "k")) == [("2", "b")]


def test_user_info(table, rows):
    users = table(
        "id bigint, user_level string, birthday string, gender string",
        (1, "1", "2006-01-07", "F"),
        (2, "2", "1996-01-10", "M"),
        (3, None, "1980-01-01", None),
        (4, None, None, "?"),
    )
    assert rows(user_info(users, F.lit(dt.date(2026, 1, 1)))) == [
        (1, "1", 19, "20岁以下", "女"),
        (2, "2", 29, "20岁到30岁", "男"),
        (3, None, 46, "30岁以上", "保密"),
        (4, None, None, None, "保密"),
    ]


def test_spu_and_sku_names(table, rows):
    tm = table("tm_id string, tm_name string", ("1", "tm one"))
    cat = table("id string, name string, category2_id string", ("5", "tea", "9"))
    spu = table(
        "id string, spu_name string, description string, category3_id string, category3_name string, "
        "tm_id string, tm_name string",
        ("7", "green", "d", "5", None, "1", None),
        ("1", "by brand", "d", "6", None, "2", "own"),
    )
    named = spu_info(spu, tm, cat)
    assert rows(named, "id", "category3_name", "tm_name") == [("1", None, "own"), ("7", "tea", "tm one")]
    sku = table(
        "id string, sku_name string, spu_id string, spu_name string, category3_id string, category3_name string, "
        "tm_id string, tm_name string",
        ("70", "s", "7", None, "5", None, "1", None),
    )
    assert rows(sku_info(sku, named, tm, cat)) == [("70", "s", "7", "green", "5", "tea", "1", "tm one")]
    assert rows(sku_info(sku, named, tm, cat, as_coded=True), "spu_name") == [("by brand",)]


ORDERS = "id bigint, user_id bigint, create_time string"
STATE = "user_id string, if_consumed string"


def flags(df):
    return {r.id: r.if_first_order for r in df.collect()}


def test_first_order_within_a_batch(table):
    orders = table(
        ORDERS,
        (1, 10, "2020-01-01 10:00:00"),
        (2, 10, "2020-01-01 09:00:00"),
        (4, 11, "2020-01-01 09:00:00"),
        (3, 11, "2020-01-01 09:00:00"),  # same time: the lower id
        (5, 12, "2020-01-01 09:00:00"),
        (6, 13, "2020-01-01 09:00:00"),
    )
    state = table(STATE, ("12", "1"), ("13", "0"), ("99", "1"))
    assert flags(flag_first_order(orders)) == {1: "0", 2: "1", 3: "1", 4: "0", 5: "1", 6: "1"}
    flagged = flag_first_order(orders, state)
    assert flags(flagged) == {1: "0", 2: "1", 3: "1", 4: "0", 5: "0", 6: "1"}
    assert sorted(tuple(r) for r in user_state_updates(flagged).collect()) == [("10", "1"), ("11", "1"), ("13", "1")]


def test_first_order_over_two_batches(table):
    one = flag_first_order(table(ORDERS, (1, 10, "2020-01-02 00:00:00")))
    two = flag_first_order(table(ORDERS, (2, 10, "2020-01-01 00:00:00")), user_state_updates(one))
    assert (flags(one), flags(two)) == ({1: "1"}, {2: "0"})


def test_a_hot_user_is_combined_before_the_shuffle(spark, plan):
    """No window over a user's orders: partial minima cross the shuffle, and the flag comes back by order id."""
    orders = spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.format_string("2020-01-01 00:%02d:00", F.col("id") % 60).alias("create_time"),
    )
    flagged = flag_first_order(orders)
    assert "Window" not in plan(flagged) and "partial_min" in plan(flagged)
    assert flagged.where("user_id = 1 and if_first_order = '1'").collect()[0].id == 0
    assert flagged.where("if_first_order = '1'").count() == flagged.select("user_id").distinct().count()


def test_enrich_order(table):
    orders = table("id bigint, province_id bigint, user_id bigint", (1, 1, 5), (2, 2, 6))
    province = table("id string, name string, area_code string, iso_code string", ("1", "北京", "110000", "CN-11"))
    user = table("id bigint, user_age_group string, user_gender string", (5, "30岁以上", "女"))
    out = {r.id: tuple(r)[3:] for r in enrich_order(orders, province, user).collect()}
    assert out == {1: ("北京", "110000", "CN-11", "30岁以上", "女"), 2: (None,) * 5}


def test_enrich_detail(table):
    sku = table(
        "id string, sku_name string, spu_id string, spu_name string, category3_id string, category3_name string, "
        "tm_id string, tm_name string",
        ("1", "s", "2", "spu", "3", "cat", "4", None),
    )
    out = enrich_detail(table("id bigint, sku_id bigint", (10, 1), (11, 9)), sku)
    columns = ["id", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name"]
    got = {r.id: tuple(r)[1:] for r in out.select(*columns).collect()}
    assert got == {10: (2, "spu", 4, None, 3, "cat"), 11: (0, None, 0, None, 0, None)}


def test_as_of_lookup(spark, table, rows):
    """The version that was valid at a fact's time, across ranges and salts; compared with a search over all versions."""
    facts = [(i, k, s, "own") for i, (k, s) in enumerate((k, s) for k in ("a", "b", "c", None) for s in (None, *range(0, 400, 7)))]
    facts += facts[:20]
    versions = [
        ("a", 5, "a1"),
        ("a", 11, "a2"),
        ("a", 11, "a3"),
        ("a", 12, "a4"),
        ("a", 300, None),
        ("b", 1, "b1"),
        ("b", 200, "b2"),
        ("b", 200, "b2"),
        (None, 1, "none"),
        ("c", None, "never"),
        ("other", 3, "x"),
    ]

    def expected(key, at):
        known = [v for v in versions if key is not None and at is not None and v[0] == key and v[1] is not None and v[1] <= at]
        return max(known, key=lambda v: (v[1], v[2] or ""))[2] if known else None

    left = table("fid int, k string, s int, name string", *facts).withColumn("at", F.timestamp_seconds("s"))
    right = table("id string, s int, name string", *versions).withColumn("since", F.timestamp_seconds("s"))
    want = sorted(((f, k, s, expected(k, s)) for f, k, s, _ in facts), key=repr)
    for seconds, salts in ((10, 1), (60, 3), (3600, 8)):
        got = as_of_lookup(left, right, "k", "id", "at", "since", ["name"], seconds, salts)
        assert rows(got, "fid", "k", "s", "name") == want
        assert rows(as_of_lookup(left.limit(0), right, "k", "id", "at", "since", ["name"], seconds, salts)) == []
    missing = as_of_lookup(left, right.limit(0), "k", "id", "at", "since", ["name"])
    assert {r.name for r in missing.collect()} == {None} and missing.count() == len(facts)
