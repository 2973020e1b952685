import json

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.session import work_dir
from tillstream.sources.keyed import KeyedTable, keys_of, upsert_latest
from tillstream.sources.readers import jdbc_read_options, kafka_options, read_dau, read_dim, read_jdbc, read_stream, read_wide
from tillstream.sources.writers import JDBC_WRITE, append_daily, append_exactly_once, kafka_sink_options, send_messages, sent_to, topic_sink, write_jdbc

STATUS = schemas.rows("id bigint, status string")


def test_upsert_latest(table, rows):
    current = table("id bigint, status string, v int", (1, "a", 1), (2, "b", 5), (3, "c", None))
    updates = table("id bigint, status string, v int", (1, "x", 2), (1, "y", 3), (2, "old", 4), (4, "new", 1), (3, "d", None))
    assert rows(upsert_latest(current, updates, ["id"], ["v"])) == [(1, "y", 3), (2, "b", 5), (3, "d", None), (4, "new", 1)]


def test_upsert_prefers_the_update_at_equal_versions(table, rows):
    current, updates = table("id int, s string, v int", (1, "a", 1)), table("id int, s string, v int", (1, "b", 1))
    assert rows(upsert_latest(current, updates, ["id"], ["v"])) == [(1, "b", 1)]


@pytest.fixture
def keyed(spark):
    return KeyedTable(spark, work_dir(spark, "keyed"), STATUS, ["id"])


def test_keyed_table_reads_the_latest(keyed, table, rows):
    assert rows(keyed.read()) == []
    keyed.upsert(table("id bigint, status string", (1, "a"), (2, "b")), 0, [])
    keyed.upsert(table("id bigint, status string", (2, "c"), (3, "d")), 1, [])
    assert rows(keyed.read()) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(keyed.read(before=1)) == [(1, "a"), (2, "b")]
    assert rows(keyed.read(before=0)) == []
    assert rows(keyed.read(only=table("id bigint", (3,), (9,)))) == [(3, "d")]


def test_a_replayed_batch_replaces_itself(keyed, table, rows):
    keyed.upsert(table("id bigint, status string", (1, "a")), 0, [])
    keyed.upsert(table("id bigint, status string", (1, "half"), (7, "lost")), 1, [])
    keyed.upsert(table("id bigint, status string", (1, "whole")), 1, [])
    assert rows(keyed.read()) == [(1, "whole")]


def test_versions_within_a_batch(spark, table, rows):
    keyed = KeyedTable(spark, work_dir(spark, "keyed"), STATUS, ["id"])
    keyed.upsert(table("id bigint, status string, at int", (1, "late", 9), (1, "early", 2)), 0, version=["at"])
    assert rows(keyed.read()) == [(1, "late")]


def test_compaction_changes_nothing_but_the_files_read(keyed, table, rows):
    for n in range(4):
        keyed.upsert(table("id bigint, status string", (n, "new"), (0, f"v{n}")), n, [])
    before = rows(keyed.read())
    keyed.compact(before=3)
    assert rows(keyed.read()) == before
    assert keyed._batches(None) == ([2], [3])
    assert rows(keyed.read(before=2)) == [(0, "v1"), (1, "new")]
    keyed.compact(before=4, keep=F.col("id") > 0)
    assert rows(keyed.read()) == [(1, "new"), (2, "new"), (3, "new")]


def test_what_a_job_reads_stays_bounded(spark, table, rows, plan):
    """100 batches: the folders and files that a read has to look at don't grow, and nothing is lost."""
    keyed = KeyedTable(spark, work_dir(spark, "keyed"), STATUS, ["id"], buckets=4, every=10)
    opened = []
    for n in range(100):
        keyed.tidy(n)
        keyed.upsert(table("id bigint, status string", (n, "new"), (n // 2, f"v{n}")).coalesce(1), n, [])
        if n % 10 == 8:
            opened.append(len(keyed.read(before=n + 1).inputFiles()))
    changes, states = (keyed._finished(kind) for kind in ("changes", "compacted"))
    assert len(changes) <= 20 and len(states) <= 2
    assert max(opened) <= 10 + 4  # changes and buckets
    assert "PartitionFilters: [(NOT (_buckets" in plan(keyed.read(only=table("id bigint", (49,))))
    expected = {n // 2: f"v{n}" for n in range(100)} | {n: "new" for n in range(50, 100)}
    assert dict(rows(keyed.read())) == expected
    # A batch that is run again sees the table as it was before it.
    assert rows(keyed.read(before=99, only=table("id bigint", (49,), (99,)))) == [(49, "v98")]


def test_another_number_of_buckets(spark, table, rows):
    path = work_dir(spark, "keyed")
    keyed = KeyedTable(spark, path, STATUS, ["id"], buckets=4)
    keyed.upsert(table("id bigint, status string", *[(n, "a") for n in range(50)]), 0, [])
    keyed.compact(before=1)
    changed = KeyedTable(spark, path, STATUS, ["id"], buckets=7)
    assert rows(changed.read(only=table("id bigint", (3,), (44,)))) == [(3, "a"), (44, "a")]


def test_sums_expire_when_compacted(spark, table, rows):
    keyed = KeyedTable(spark, work_dir(spark, "keyed"), STATUS, ["id"], every=2)
    for n in range(3):
        keyed.tidy(n, lambda: F.col("id") > 0)
        keyed.upsert(table("id bigint, status string", (n, "a")), n, [])
    assert rows(keyed.read()) == [(1, "a"), (2, "a")]


def test_an_unfinished_write_is_not_read(keyed, table, rows, spark):
    keyed.upsert(table("id bigint, status string", (1, "a")), 0, [])
    option = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    half = table("id bigint, status string", (1, "half")).write.option(option, "false")
    half.parquet(f"{keyed.path}/changes/batch_id=1")
    assert rows(keyed.read()) == [(1, "a")]


def test_keys_of(keyed, table, rows):
    assert rows(keys_of(table("uid string", ("5",), ("5",), ("6",)), "uid", keyed)) == [(5,), (6,)]


def test_append_exactly_once(spark, table, rows):
    path = work_dir(spark, "stat")
    append_exactly_once(table("x int", (1,)), path, 0)
    for _ in range(2):
        append_exactly_once(table("x int", (2,), (3,)), path, 1)
    assert rows(spark.read.parquet(path), "x") == [(1,), (2,), (3,)]
    append_exactly_once(table("x int"), path, 1)
    assert rows(spark.read.parquet(path), "x") == [(1,)]


def test_daily_index_is_pruned_by_day(spark, rows, plan):
    path = work_dir(spark, "dau")
    columns = schemas.DAU_INFO
    day = lambda d, m: (m, "u", "a", "c", "v", d, "01", "00", 1)
    append_daily(spark.createDataFrame([day("2020-06-01", "m1"), day("2020-06-02", "m1")], columns), path, 0)
    append_daily(spark.createDataFrame([day("2020-06-02", "m2")], columns), path, 1)
    assert rows(read_dau(spark, path, "2020-06-02"), "mid") == [("m1",), ("m2",)]
    text = plan(read_dau(spark, path, "2020-06-02"))
    assert "PartitionFilters: [isnotnull(dt" in text and read_dau(spark, path).columns == columns.names


def test_read_wide(spark):
    path = work_dir(spark, "wide")
    append_daily(spark.createDataFrame([tuple(None for _ in schemas.ORDER_WIDE)], schemas.ORDER_WIDE).withColumn("dt", F.lit("2020-06-01")), path, 3)
    assert read_wide(spark, path).columns == schemas.ORDER_WIDE.names
    assert read_wide(spark, path).where("dt = '2020-06-01'").count() == 1


def test_read_dim_pushes_columns_and_filter_down(spark, plan):
    path = "/root/testdata/sf0.001/part.parquet"
    text = plan(read_dim(spark, path, ["p_name"], F.col("p_partkey").isin(1, 2)))
    assert "PushedFilters: [In(p_partkey, [1,2])]" in text and "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_messages_by_topic(spark, table, rows):
    path = work_dir(spark, "topics")
    send_messages(table("topic string, value string", ("A", "1"), ("B", "2")), path, 0)
    assert rows(spark.read.parquet(sent_to(path, "B")), "value") == [("2",)]


def test_messages_are_sent_once(spark, table, rows):
    """A batch that is run again leaves its files alone; one that was not finished does not show."""
    path = work_dir(spark, "topics")
    table("value string", ("half",)).write.parquet(f"{path}/_drafts/run=none/batch_id=0")
    assert rows(spark.read.schema("value string").parquet(path)) == []
    send_messages(table("value string", ("1",)), path, 0)
    files = spark.read.parquet(path).inputFiles()
    send_messages(table("value string", ("1",)), path, 0)
    assert spark.read.parquet(path).inputFiles() == files and rows(spark.read.parquet(path), "value") == [("1",)]


def test_daily_layout(spark, rows):
    """A day is one folder; a batch that is run again replaces its part of each day."""
    path = work_dir(spark, "daily")
    for batch_id, rows_ in ((0, [(1, "a"), (2, "b")]), (1, [(3, "a")]), (1, [(4, "a")])):
        append_daily(spark.createDataFrame(rows_, "x int, dt string"), path, batch_id)
    assert rows(spark.read.parquet(path), "x", "dt") == [(1, "a"), (2, "b"), (4, "a")]
    assert rows(spark.read.parquet(f"{path}/dt=a"), "x") == [(1,), (4,)]


def test_topic_sink_reaches_the_broker_writer(spark, table):
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_sink("h:9092")(table("topic string, value string", ("A", "1")), 0)


def test_kafka_options():
    fresh = kafka_options("h:9092", ["A", "B"], "g")
    assert fresh == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "A,B",
        "startingOffsets": "latest",
        "kafka.group.id": "g",
    }
    stored = kafka_options("h:9092", ["A"], offsets={"A": {0: 5, 1: 7}}, max_offsets=100)
    assert json.loads(stored["startingOffsets"]) == {"A": {"0": 5, "1": 7}}
    assert stored["maxOffsetsPerTrigger"] == "100"
    assert kafka_sink_options("h:9092", "T")["topic"] == "T" and "topic" not in kafka_sink_options("h:9092")


def test_kafka_needs_its_connector(spark):
    """The connector is not part of this installation; Spark says so by its name."""
    with pytest.raises(Exception, match="(?i)kafka"):
        read_stream(spark, "kafka", kafka_options("h:9092", ["A"]))


def test_jdbc_options():
    assert jdbc_read_options("jdbc:x", "select 1") == {"url": "jdbc:x", "query": "select 1"}
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    assert jdbc_read_options("jdbc:x", "select 1", split)["dbtable"] == "(select 1) t"
    assert JDBC_WRITE == {"batchsize": "100", "isolationLevel": "NONE"}


def test_jdbc_needs_a_driver(spark, table):
    with pytest.raises(Exception, match="(?i)driver"):
        read_jdbc(spark, "jdbc:none:x", "select 1")
    with pytest.raises(Exception, match="(?i)driver"):
        write_jdbc(table("x int", (1,)), "jdbc:none:x", "t")


def test_work_dir_is_new_each_time(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "a") != work_dir(spark, "a") and work_dir(spark, "a").startswith(root)
