"""Streams give what the same rows give as one table, whatever the batches; failures and restarts change nothing."""

import json

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.ads import amount_stat
from tillstream.operators.dims import user_info
from tillstream.operators.dws import first_arrived, first_seen, join_orders, split_amount, wide_row
from tillstream.operators.ods import route_maxwell, to_messages
from tillstream.session import SKEW_SETTINGS, STATE_SETTINGS, rocksdb_state, work_dir
from tillstream.sources.keyed import KeyedTable
from tillstream.sources.readers import read_dau, read_stream, read_wide
from tillstream.sources.writers import finish, sent_to, write_stream
from tillstream.streaming import jobs

START = 1_704_067_200


class Topic:
    """A folder of messages; each ``send`` adds one file, and the stream takes one file per batch."""

    def __init__(self, spark, path, schema="value string"):
        self.spark, self.path, self.schema = spark, path, schema
        self.send()

    def send(self, *rows):
        df = self.spark.createDataFrame(list(rows), self.schema)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, files=1):
        schema = self.spark.createDataFrame([], self.schema).schema
        return read_stream(self.spark, "parquet", {"maxFilesPerTrigger": str(files)}, self.path, schema)


@pytest.fixture
def work(spark):
    return work_dir(spark, "stream")


def order_rows(n):
    """Orders of three lines, 30.00 each, 20.00 paid; every fourth order arrives too late for its lines."""
    return [(i, 30.0, 20.0, "2024-01-01", START + i + (30 if i % 4 == 3 else 0)) for i in range(n)]


def line_rows(n):
    return [(i * 10 + j, i, 1, 10.0, START + i + j) for i in range(n) for j in range(3)]


ORDERS = "id bigint, original_total_amount double, final_total_amount double, create_date string, second bigint"
LINES = "id bigint, order_id bigint, sku_num bigint, order_price double, second bigint"


def at(df):
    return df.withColumn("arrived", F.timestamp_seconds("second"))


def wide_setup(spark, work, files, n=12):
    orders, lines = Topic(spark, f"{work}/orders", ORDERS), Topic(spark, f"{work}/lines", LINES)
    for part in range(files):
        orders.send(*[r for r in order_rows(n) if r[0] * files // n == part])
        lines.send(*[r for r in line_rows(n) if r[1] * files // n == part])
        # Some are sent again.
        orders.send(*[r for r in order_rows(n) if r[0] * files // n == part and r[0] % 2 == 0])
        lines.send(*[r for r in line_rows(n) if r[1] * files // n == part and r[0] % 10 == 1])
    return orders, lines


def run_wide(spark, work, orders, lines, **options):
    wide = jobs.wide_stream(at(orders.stream()), at(lines.stream()), "arrived", "arrived", **options)
    return jobs.order_wide_job(wide, f"{work}/wide", f"{work}/cp", messages=f"{work}/messages")


def batch_wide(spark, n=12):
    orders = at(spark.createDataFrame(order_rows(n), ORDERS))
    lines = at(spark.createDataFrame(line_rows(n), LINES))
    return split_amount(join_orders(orders, lines, "arrived", "arrived"))


COLUMNS = ["order_id", "order_detail_id", "final_detail_amount"]


@pytest.mark.parametrize("files, salts", [(1, 1), (3, 4)])
def test_wide_stream_equals_the_table(spark, work, rows, files, salts):
    orders, lines = wide_setup(spark, work, files)
    finish(run_wide(spark, work, orders, lines, salts=salts), 300)
    stored = read_wide(spark, f"{work}/wide")
    expected = rows(batch_wide(spark), *COLUMNS)
    assert len(expected) == 27  # nine orders of three lines
    # A complete order's shares add up whatever the batches; which line takes the cent may differ.
    assert rows(stored, "order_id", "order_detail_id") == [r[:2] for r in expected]
    paid = stored.groupBy("order_id").agg(F.sum(F.col("final_detail_amount").cast("decimal(18,2)")).alias("p"))
    assert {float(r.p) for r in paid.collect()} == {20.0}
    if files == 1:
        assert rows(stored, *COLUMNS) == expected
    sent = [json.loads(r.value) for r in spark.read.parquet(f"{work}/messages").collect()]
    assert len(sent) == 27 and sent[0]["dt"] == "2024-01-01"


def test_a_failed_batch_is_run_again_without_traces(spark, work, rows, monkeypatch):
    orders, lines = wide_setup(spark, work, 3)
    store, failed = jobs.append_daily, []

    def fail_once(df, path, batch_id):
        store(df, path, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("executor lost")

    monkeypatch.setattr(jobs, "append_daily", fail_once)
    with pytest.raises(Exception, match="executor lost"):
        finish(run_wide(spark, work, orders, lines), 300)
    finish(run_wide(spark, work, orders, lines), 300)
    stored = read_wide(spark, f"{work}/wide")
    assert failed == [1]
    assert rows(stored, "order_id", "order_detail_id") == rows(batch_wide(spark), "order_id", "order_detail_id")
    assert stored.agg(F.sum(F.col("final_detail_amount").cast("decimal(18,2)"))).collect()[0][0] == 180


def test_lines_of_one_order_over_batches(spark, work):
    """The sums of earlier lines are carried; they end after their life."""
    orders, lines = Topic(spark, f"{work}/orders", ORDERS), Topic(spark, f"{work}/lines", LINES)
    orders.send((1, 30.0, 20.0, "2024-01-01", START), (2, 30.0, 20.0, "2024-01-01", START))
    late = START + 3
    for j in range(3):
        lines.send((10 + j, 1, 1, 10.0, START + j), (20 + j, 2, 1, 10.0, late if j == 2 else START))
    wide = jobs.wide_stream(at(orders.stream()), at(lines.stream()), "arrived", "arrived")
    finish(jobs.order_wide_job(wide, f"{work}/wide", f"{work}/cp", life="2 seconds"), 300)
    got = {r.order_detail_id: r.final_detail_amount for r in read_wide(spark, f"{work}/wide").collect()}
    assert got == {10: 6.67, 11: 6.67, 12: 6.66, 20: 6.67, 21: 6.67, 22: 6.67}


LOG = '{"common":{"mid":"%s","uid":"u","ar":"a","ch":"c","vc":"v"},"start":{},"ts":%d}'


def log(mid, seconds):
    return (LOG % (mid, (START + seconds) * 1000),)


@pytest.mark.parametrize("life", ["24 hours", None])
def test_dau_keeps_one_start_per_device_and_day(spark, work, rows, life):
    logs = Topic(spark, f"{work}/logs")
    logs.send(log("m1", 5), log("m1", 9), log("m2", 7))
    logs.send(log("m1", 20), log("m3", 21), log("m1", 86_400 + 1))
    run = lambda: finish(jobs.dau_job(logs.stream(), f"{work}/dau", f"{work}/cp", life=life), 300)
    run()
    first = [("2024-01-01", "m1"), ("2024-01-01", "m2"), ("2024-01-01", "m3"), ("2024-01-02", "m1")]
    assert rows(read_dau(spark, f"{work}/dau"), "dt", "mid") == first
    # Started again, the job takes only what is new and knows the devices it has seen.
    logs.send(log("m2", 86_400 - 1), log("m4", 30), log("m1", 86_400 + 2))
    run()
    assert rows(read_dau(spark, f"{work}/dau"), "dt", "mid") == sorted([*first, ("2024-01-01", "m4")], key=repr)


@pytest.mark.parametrize("salts", [1, 4])
def test_repeats_are_dropped_whatever_the_salt(spark, work, rows, salts):
    topic = Topic(spark, f"{work}/in", "k bigint, second bigint")
    for part in range(2):
        topic.send(*[(1, START) for _ in range(300)], *[(i, START) for i in range(100)])
    seen = first_arrived(at(topic.stream()).withWatermark("arrived", "1 hour"), ["k"], True, salts)
    finish(write_stream(seen, "parquet", f"{work}/cp", {"path": f"{work}/out"}), 300)
    assert rows(spark.read.parquet(f"{work}/out"), "k") == sorted([(i,) for i in range(100)], key=repr)


def order_message(i, user, time, **more):
    return (json.dumps({"id": str(i), "user_id": str(user), "province_id": "1", "create_time": time, **more}),)


def order_tables(spark, work, table):
    make = lambda name, schema, key: KeyedTable(spark, f"{work}/{name}", schema, [key])
    province, user = make("province", schemas.PROVINCE_INFO, "id"), make("user", schemas.USER_INFO, "id")
    province.upsert(table("id string, name string, area_code string, iso_code string", ("1", "北京", "11", "CN")), 0, [])
    user.upsert(table(schemas.USER_INFO, (5, "1", 40, "30岁以上", "女")), 0, [])
    return {
        "consumed": None,
        "orders": make("orders", schemas.ORDER_INFO, "id"),
        "province": province,
        "user": user,
    }


def test_first_orders_over_batches_and_a_failure(spark, work, table, rows, monkeypatch):
    messages = Topic(spark, f"{work}/in")
    messages.send(order_message(1, 5, "2024-01-01 10:00:00"), order_message(2, 5, "2024-01-01 09:00:00"))
    messages.send(order_message(3, 5, "2024-01-01 08:00:00"), order_message(4, 6, "2024-01-01 08:00:00"))
    tables = order_tables(spark, work, table)
    upsert, failed = KeyedTable.upsert, []

    def fail_once(self, df, batch_id, *version):
        upsert(self, df, batch_id, *version)
        if self is tables["orders"] and batch_id == 1 and not failed:
            failed.append(1)
            raise RuntimeError("driver lost")

    monkeypatch.setattr(KeyedTable, "upsert", fail_once)
    run = lambda: finish(jobs.order_info_job(messages.stream(), **tables, send=f"{work}/out", checkpoint=f"{work}/cp"), 300)
    with pytest.raises(Exception, match="driver lost"):
        run()
    run()
    facts = tables["orders"].read()
    assert failed and rows(facts, "id", "if_first_order") == [(1, "0"), (2, "1"), (3, "0"), (4, "1")]
    assert rows(facts.where("id = 1"), "province_name", "user_gender", "create_date", "create_hour") == [
        ("北京", "女", "2024-01-01", "10")
    ]
    assert rows(facts.where("id = 4"), "user_gender", "final_total_amount") == [(None, 0.0)]
    sent = [(r.key, json.loads(r.value)["if_first_order"]) for r in spark.read.parquet(f"{work}/out").collect()]
    assert sorted(sent) == [("1", "0"), ("2", "1"), ("3", "0"), ("4", "1")]


def test_a_snapshot_tells_who_has_ordered(spark, work, table, rows):
    """It counts when the query starts for the first time; a user who is not in it becomes known by the first order."""
    messages, tables = Topic(spark, f"{work}/in"), order_tables(spark, work, table)
    when = "2024-01-01 10:00:00"
    messages.send(order_message(1, 5, when), order_message(2, 6, when), order_message(3, 7, when))
    tables["consumed"] = table(schemas.USER_STATE, ("5", "1"), ("5", "1"), ("9", "1"))
    run = lambda: finish(jobs.order_info_job(messages.stream(), **tables, send=f"{work}/out", checkpoint=f"{work}/cp"), 300)
    run()
    messages.send(order_message(4, 6, when), order_message(5, 8, when), order_message(6, 9, when), order_message(7, 7, when))
    run()
    assert rows(tables["orders"].read(), "id", "if_first_order") == [
        (1, "0"), (2, "1"), (3, "1"), (4, "0"), (5, "1"), (6, "0"), (7, "0")
    ]


def test_sums_live_an_hour_after_the_last_line(spark, work):
    """Lines an hour apart each time keep the sums alive; after a longer pause they count no more."""
    wide = Topic(spark, f"{work}/met", "order_id bigint, order_detail_id bigint, sku_num bigint, second bigint")
    for second, (kept, lost) in ((0, (1, 2)), (3600, (1, None)), (7200, (1, None)), (7201, (None, 2)), (7300, (None, 2))):
        sent = [(order, 10 * order + second // 3600 + second % 60, 1, START + second) for order in (kept, lost) if order]
        wide.send(*sent)
    rows = at(wide.stream()).withColumnRenamed("arrived", "event_time").withColumns(
        {"sku_price": F.lit(10.0), "original_total_amount": F.lit(30.0), "final_total_amount": F.lit(20.0)}
    )
    full = wide_row(rows.withWatermark("event_time", "1 minute"), "event_time")
    finish(jobs.order_wide_job(full, f"{work}/wide", f"{work}/cp", daily=False), 300)
    paid = {}
    for r in read_wide(spark, f"{work}/wide").collect():
        paid.setdefault(r.order_id, []).append(r.final_detail_amount)
    assert sorted(paid[1]) == [6.66, 6.67, 6.67] and sorted(paid[2]) == [6.67, 6.67, 6.67]


def test_a_device_is_remembered_from_its_last_start(spark, work, rows):
    """24 hours begin again with each start, whatever the order of rows within a batch."""
    logs = Topic(spark, f"{work}/logs", "value string, second bigint")
    sent = {"steady": (0, 20, 40, 60), "pause": (0, 23, 48), "once": (40,), "mixed": (70, 0, 20, 90)}
    for hours in ((0,), (20, 23), (40, 48), (60, 70, 90)):
        # A device's own time is its day; arrival is the topic's.
        logs.send(*[(log(m, 5)[0], START + 3600 * h) for m, own in sent.items() for h in own if h in hours])
    arrived = logs.stream().withColumn("timestamp", F.timestamp_seconds("second")).drop("second")
    finish(jobs.dau_job(arrived, f"{work}/dau", f"{work}/cp"), 300)
    found = [r[0] for r in rows(read_dau(spark, f"{work}/dau"), "mid")]
    assert found == ["mixed", "mixed", "once", "pause", "pause", "steady"]


def test_details_see_the_dimension_of_their_batch(spark, work, table, rows):
    """A SKU that comes later is seen by later lines only."""
    messages = Topic(spark, f"{work}/in")
    sku = KeyedTable(spark, f"{work}/sku", schemas.SKU_INFO, ["id"])
    details = KeyedTable(spark, f"{work}/details", schemas.ORDER_DETAIL, ["id"])
    run = lambda: finish(jobs.order_detail_job(messages.stream(), sku, details, f"{work}/out", f"{work}/cp"), 300)
    messages.send(('{"id":1,"sku_id":7}',))
    run()
    sku.upsert(table(schemas.SKU_INFO, ("7", "s", "2", "spu", "3", "cat", "4", "tm")), 0, [])
    messages.send(('{"id":2,"sku_id":7}',))
    run()
    assert rows(details.read(), "id", "spu_id", "spu_name") == [(1, 0, None), (2, 2, "spu")]


def test_dimension_job_keeps_the_latest(spark, work, rows):
    messages = Topic(spark, f"{work}/in")
    users = KeyedTable(spark, f"{work}/users", schemas.USER_INFO, ["id"])
    messages.send(('{"id":"1","user_level":"1","birthday":"1970-01-01","gender":"F"}',))
    messages.send(('{"id":"1","user_level":"2","birthday":"1970-01-01","gender":"M"}',))
    build = lambda df: user_info(df, F.lit("2026-01-01").cast("date"))
    finish(jobs.dim_job(messages.stream(), schemas.USER_RECORD, users, f"{work}/cp", build), 300)
    assert rows(users.read()) == [(1, "2", 56, "30岁以上", "男")]


def test_statistics_are_deltas_per_batch(spark, work, rows):
    wide = spark.createDataFrame(
        [(i, 1 if i < 3 else 2, "tm", 1.25) for i in range(6)],
        "order_detail_id bigint, tm_id bigint, tm_name string, final_detail_amount double",
    )
    messages = Topic(spark, f"{work}/in")
    texts = [(r.value,) for r in to_messages(wide).collect()]
    for part in (texts[:2], texts[2:5], texts[5:]):
        messages.send(*part)
    finish(jobs.stat_job(messages.stream(), "trademark", f"{work}/stat", f"{work}/cp"), 300)
    stored = spark.read.parquet(f"{work}/stat")
    assert rows(stored, "id", "amount") == [("1", 1.25), ("1", 2.5), ("2", 1.25), ("2", 2.5)]
    total = stored.groupBy("id").agg(F.sum("amount").alias("amount"))
    assert rows(total) == rows(amount_stat(wide, "trademark"), "id", "amount")


def test_router_job(spark, work, rows):
    changes = Topic(spark, f"{work}/in")
    changes.send(('{"table":"order_info","data":{"id":1}}',), ('{"table":"other","data":{"id":2}}',))
    finish(jobs.message_job(changes.stream(), route_maxwell, f"{work}/out", f"{work}/cp"), 300)
    assert rows(spark.read.parquet(f"{work}/out"), "topic", "value") == [("ODS_ORDER_INFO", '{"id":1}')]


def test_stream_dedup_equals_the_table(spark, work, rows):
    topic = Topic(spark, f"{work}/in", "k bigint, second bigint")
    data = [(i % 7, START + i) for i in range(40)]
    topic.send(*data)
    finish(
        write_stream(first_arrived(topic.stream(), ["k"], False), "parquet", f"{work}/cp", {"path": f"{work}/out"}), 300
    )
    table = first_seen(spark.createDataFrame(data, topic.schema), ["k"], ["second"])
    assert rows(spark.read.parquet(f"{work}/out"), "k") == rows(table, "k")


def test_the_callers_settings_come_back(spark):
    key = next(iter(STATE_SETTINGS))
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with rocksdb_state(spark):
            assert spark.conf.get(key) == STATE_SETTINGS[key]
        assert spark.conf.get(key).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(key, before)
    assert all(spark.conf.get(k) == v for k, v in SKEW_SETTINGS.items())


def test_micro_batches_run_adaptively(spark, work):
    topic, seen = Topic(spark, f"{work}/in", "k bigint, second bigint"), []
    topic.send((1, 1))

    def sink(batch, batch_id):
        seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        batch.collect()

    finish(write_stream(topic.stream().dropDuplicates(["k"]), sink, f"{work}/cp"), 300)
    assert set(seen) == {"true"}


def test_last_write_wins_in_a_batch(spark, work, table, rows):
    """The message that arrived last stays, whatever its values; an order and its change are one first order."""

    def topic(name, *messages):
        topic = Topic(spark, f"{work}/{name}")
        topic.send(*messages)
        schema = spark.createDataFrame([], "value string").schema
        return read_stream(spark, "parquet", {}, f"{work}/{name}", schema, ordered=True)

    brand = lambda i, name: (json.dumps({"tm_id": i, "tm_name": name}),)
    brands = KeyedTable(spark, f"{work}/brands", schemas.BASE_TRADEMARK, ["tm_id"])
    sent = topic("tm", brand("1", "Alpha"), brand("2", "Zeta"), brand("1", "Zeta"), brand("2", "Alpha"))
    finish(jobs.dim_job(sent, schemas.BASE_TRADEMARK, brands, f"{work}/cp_tm"), 300)
    assert rows(brands.read()) == [("1", "Zeta"), ("2", "Alpha")]

    tables = order_tables(spark, work, table)
    when = "2024-01-01 10:00:00"
    orders = topic("orders", order_message(1, 5, when, order_status="1001"), order_message(1, 5, when, order_status="1002"))
    finish(jobs.order_info_job(orders, **tables, send=f"{work}/out", checkpoint=f"{work}/cp"), 300)
    assert rows(tables["orders"].read(), "id", "order_status", "if_first_order") == [(1, "1002", "1")]
    flags = [json.loads(r.value)["if_first_order"] for r in spark.read.parquet(f"{work}/out").collect()]
    assert flags == ["1"]


def test_a_wrong_device_clock_loses_no_other_device(spark, work, rows):
    logs = Topic(spark, f"{work}/logs")
    for mid, seconds in (("a", 5), ("future", 400 * 86_400), ("b", 6), ("c", 7)):
        logs.send(log(mid, seconds))
    finish(jobs.dau_job(logs.stream(), f"{work}/dau", f"{work}/cp"), 300)
    assert {r.mid for r in read_dau(spark, f"{work}/dau").collect()} == {"a", "future", "b", "c"}


def test_an_empty_statistics_batch_writes_nothing(spark, work):
    topic = Topic(spark, f"{work}/in")
    topic.send((None,))
    finish(jobs.stat_job(topic.stream(), "category", f"{work}/stat", f"{work}/cp"), 300)
    assert not spark._jvm.java.io.File(f"{work}/stat".removeprefix("file:")).exists()


def test_a_new_checkpoint_loses_and_overwrites_nothing(spark, work, rows):
    """Another query counts its batches from 0 too; what it sends and stores comes beside what is there."""
    change = lambda i: (json.dumps({"table": "order_info", "data": {"id": i}}),)

    def follower():
        schema = spark.createDataFrame([], "value string").schema
        sent = read_stream(spark, "parquet", {}, sent_to(f"{work}/out", "ODS_ORDER_INFO"), schema)
        finish(write_stream(sent, "parquet", f"{work}/cp_seen", {"path": f"{work}/seen"}), 300)

    for name in ("a", "b"):
        changes, logs = Topic(spark, f"{work}/in_{name}"), Topic(spark, f"{work}/logs_{name}")
        changes.send(change(name))
        logs.send(log(name, 5))
        for _ in range(2):
            # The second start goes on from the checkpoint and has nothing to do.
            finish(jobs.message_job(changes.stream(), route_maxwell, f"{work}/out", f"{work}/cp_{name}"), 300)
        finish(jobs.dau_job(logs.stream(), f"{work}/dau", f"{work}/cp_dau_{name}"), 300)
        follower()
    assert rows(spark.read.parquet(f"{work}/seen"), "value") == [('{"id":"a"}',), ('{"id":"b"}',)]
    assert rows(read_dau(spark, f"{work}/dau"), "mid") == [("a",), ("b",)]
