"""What keeps streams fast on large tables: few calls to the state store, no shuffle that is not needed, files that split."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.ods import to_messages
from tillstream.plans.entities import Entities
from tillstream.session import work_dir
from tillstream.sources.keyed import KeyedTable
from tillstream.sources.writers import OPEN_FILES, finish, send_messages, write_stream
from tillstream.streaming.state import FirstStart, SplitOrder, newcomers, with_newcomers

HOUR = 3_600_000


class Store:
    """A map state and its handle, with the number of calls."""

    def __init__(self):
        self.rows, self.calls, self.timers = {}, 0, []

    def getMapState(self, name, key, value):  # noqa: N802
        return self

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def exists(self):
        self.calls += 1
        return bool(self.rows)

    def getValue(self, key):  # noqa: N802
        self.calls += 1
        return self.rows.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.rows[key] = value

    def iterator(self):
        return iter([*self.rows.items()])

    def removeKey(self, key):  # noqa: N802
        del self.rows[key]

    def clear(self):
        self.rows.clear()


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.now


def run(processor, rows):
    return [tuple(r) for r in processor.handleInputRows((0,), iter(rows), None)]


def test_devices_of_a_group_share_their_timer_and_end_one_by_one():
    store = Store()
    first = FirstStart(24 * HOUR, ["dt", "mid"], schemas.rows("dt string, mid string"))
    first.init(store)
    start = lambda mid, hour: ("d", mid, None, hour * HOUR, 0)
    assert len(run(first, [start(f"m{i}", 0) for i in range(100)])) == 100
    # A new group is asked once, and each device is written once.
    assert store.calls == 101 and len(store.timers) == 1
    # Every start renews; the rows of a batch come in any order; a device without an id is one, too.
    rows = [start("m1", 50), start("m1", 20), start("m2", 24), start("m3", 25), start(None, 9), start(None, 8)]
    assert run(first, rows) == [("d", "m1"), ("d", "m3"), ("d", None)]
    list(first.handleExpiredTimer((0,), Clock(34 * HOUR), None))
    assert sorted(m for _, m in store.rows) == ["m1", "m2", "m3"] and store.timers[-1] == 48 * HOUR + 1
    list(first.handleExpiredTimer((0,), Clock(99 * HOUR), None))
    assert not store.rows and len(store.timers) == 2


def test_orders_of_a_group_are_split_each_by_itself():
    store, names = Store(), ["order_detail_id", "order_id", "final_detail_amount"]
    split = SplitOrder(HOUR, names)
    split.init(store)
    # id, order, event time, line, share, original, paid (cents), ms, group: two orders of three lines, mixed.
    line = lambda order, j, at=0: (order * 10 + j, order, None, 1000, 667, 3000, 2000, at, 0)
    found = run(split, [line(1, 0), line(2, 2), line(1, 2), line(2, 0), line(1, 1)])
    assert sorted(found) == [(10, 1, 6.67), (11, 1, 6.67), (12, 1, 6.66), (20, 2, 6.67), (22, 2, 6.67)]
    assert store.calls == 3
    assert run(split, [line(2, 1, HOUR)]) == [(21, 2, 6.66)]
    assert store.rows[2,] == (3000, 2000, HOUR)


def test_newcomers_are_told_once(spark):
    work = work_dir(spark, "newcomers")
    known = spark.createDataFrame([(7,), (7,), (9,)], "user_id bigint")
    known.write.parquet(f"{work}/known")
    for ids in ([(5, 1), (5, 2), (7, 3)], [(5, 4), (6, 5), (9, 6)]):
        spark.createDataFrame(ids, "user_id bigint, id bigint").coalesce(1).write.mode("append").parquet(f"{work}/orders")
    source = spark.readStream.schema("user_id bigint, id bigint").option("maxFilesPerTrigger", 1).parquet(f"{work}/orders")
    stream = with_newcomers(source, spark.readStream.schema(known.schema).parquet(f"{work}/known"))
    seen, orders = [], []

    def each(batch, n):
        rows = batch.persist()
        orders.append(rows.where("_kind = 'order'").count())
        seen.append(sorted(r.user_id for r in newcomers(rows).collect()))
        rows.unpersist()

    finish(write_stream(stream, each, f"{work}/cp"), 300)
    assert orders == [3, 3] and seen == [[5], [6]]


@pytest.mark.parametrize("files, shuffled", [(1, True), (8, False)])
def test_only_a_table_of_few_parts_is_dealt_out(spark, plan, files, shuffled):
    folder = work_dir(spark, "tables")
    spark.range(40_000).withColumn("v", F.xxhash64("id")).repartition(files).write.parquet(f"{folder}/orders.parquet")
    table = Entities(spark, folder, spread=True).table("orders")
    # The session has eight cores, and each file is a part.
    assert ("Exchange" in plan(table)) == shuffled and table.count() == 40_000


def test_messages_are_written_unsorted_in_files_that_split(spark):
    path, before = work_dir(spark, "sent"), spark.conf.get(OPEN_FILES)
    rows = spark.range(0, 60_000, 1, 1).select("id", F.concat(*[F.sha2(F.concat("id", F.lit(x)), 512) for x in "abcd"]).alias("text"))
    messages = to_messages(rows, topic=F.concat(F.lit("T"), F.col("id") % 2))
    send_messages(messages, path, 0)
    files = glob.glob(f"{path.removeprefix('file:')}/run=none/batch_id=0/topic=*/*.parquet")
    assert len(files) == 2 and min(pq.ParquetFile(f).num_row_groups for f in files) > 1
    assert spark.conf.get(OPEN_FILES) == before
    assert spark.read.parquet(path).count() == 60_000


def test_rows_of_unique_keys_are_written_without_a_shuffle(spark):
    table = KeyedTable(spark, work_dir(spark, "unique"), schemas.rows("id bigint, v string"), ["id"])
    rows = spark.range(0, 100, 1, 7).select("id", F.lit("a").alias("v"))
    table.upsert(rows, 0, None)
    files = glob.glob(f"{table.path.removeprefix('file:')}/changes/batch_id=0/*.parquet")
    assert len(files) == 7 and table.read().count() == 100
