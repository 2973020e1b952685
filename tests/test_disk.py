"""What streams leave on disk: shuffle files go with their batch, copies and consumed rows are not kept."""

import os
import time

from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.dws import first_arrived, join_orders
from tillstream.session import no_shuffles_left, work_dir
from tillstream.sources.keyed import KeyedTable
from tillstream.sources.readers import read_stream
from tillstream.sources.writers import finish, write_stream
from tillstream.streaming import jobs

START = 1_704_067_200


def blocks(spark):
    """The shuffle files of this session."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_over(spark, before):
    """Files are removed by another thread."""
    for _ in range(50):
        new = blocks(spark) - before
        if not new:
            break
        time.sleep(0.1)
    return new


def follow(spark, path, rows, files):
    rows.repartition(files).write.parquet(path)
    return read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, path, rows.schema)


def test_shuffle_files_go_with_their_batch(spark):
    work, seen = work_dir(spark, "shuffles"), []
    rows = spark.range(300).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(START)).alias("at"))
    stream = first_arrived(follow(spark, f"{work}/in", rows, 3).withWatermark("at", "1 hour"), ["k"], True, 1)
    before = blocks(spark)

    def each(batch, n):
        # Nothing is there of the batches before.
        seen.append(left_over(spark, before))
        batch.groupBy("at").count().write.parquet(f"{work}/out/{n}")
        assert blocks(spark) - before

    finish(write_stream(stream, each, f"{work}/cp"), 300)
    assert len(seen) >= 3 and not any(seen) and not left_over(spark, before)
    assert spark.read.parquet(f"{work}/out/*").agg(F.sum("count")).first()[0] == 300


def test_a_write_removes_its_shuffle_files(spark):
    before = blocks(spark)
    with no_shuffles_left(spark):
        spark.range(100).repartition(3, "id").write.parquet(work_dir(spark, "written"))
    assert not left_over(spark, before)


def sent(spark, copies):
    """Lines of 300 orders, each sent ``copies`` times in one arrival batch; id 5 stands for lines of two orders."""
    orders = spark.range(300).select("id", F.lit("2024-01-01").alias("create_date"), F.timestamp_seconds(F.lit(START)).alias("at"))
    lines = spark.range(300 * copies).select(
        F.when(F.col("id") % 300 == 6, 5).otherwise(F.col("id") % 300).alias("id"),
        (F.col("id") % 300).alias("order_id"),
        F.sha2((F.col("id") % 300).cast("string"), 512).alias("sku_name"),
        F.timestamp_seconds(F.lit(START)).alias("at"),
    )
    return orders, lines


def test_copies_of_lines_meet_no_order(spark, rows):
    orders, lines = sent(spark, 3)
    columns = ["order_id", "order_detail_id", "sku_name"]
    thin = join_orders(orders, lines, "at", "at", line_repeats=True)
    assert rows(thin, *columns) == rows(join_orders(orders, lines.distinct(), "at", "at"), *columns)
    assert thin.count() == 300


def test_copies_of_lines_are_no_state_of_the_join(spark, rows):
    """The log of changes grows by a narrow row for each line, not by a wide one for each copy."""
    work, size, found = work_dir(spark, "copies"), {}, {}
    for thin in (False, True):
        orders, lines = sent(spark, 20)
        at = f"{work}/{thin}"
        wide = jobs.wide_stream(
            follow(spark, f"{at}/orders", orders, 1), follow(spark, f"{at}/lines", lines, 1), "at", "at", salts=1, line_repeats=thin
        )
        finish(write_stream(wide, "parquet", f"{at}/cp", {"path": f"{at}/out"}), 300)
        logs = [f"{d}/{f}" for d, _, fs in os.walk(f"{at}/cp".removeprefix("file:")) for f in fs if f.endswith(".changelog")]
        size[thin] = sum(map(os.path.getsize, logs))
        found[thin] = rows(spark.read.parquet(f"{at}/out"), "order_detail_id")
    assert found[True] == found[False] and len(found[True]) == 299
    assert 0 < size[True] < 0.8 * size[False]


def test_details_keep_only_keys_while_they_run(spark, table, rows, monkeypatch):
    work, kept, reused = work_dir(spark, "details"), [], jobs._reused
    sku = KeyedTable(spark, f"{work}/sku", schemas.SKU_INFO, ["id"])
    sku.upsert(table(schemas.SKU_INFO, ("7", "s", "2", "spu", "3", "cat", "4", "tm")), 0, [])
    details = KeyedTable(spark, f"{work}/details", schemas.ORDER_DETAIL, ["id"])

    def record(df):
        kept.append(df.columns)
        return reused(df)

    monkeypatch.setattr(jobs, "_reused", record)
    texts = ['{"id":1,"sku_id":7,"sku_name":"x"}', '{"id":2,"sku_id":8}', '{"id":2,"sku_id":8}', None]
    messages = follow(spark, f"{work}/in", table("value string", *[(t,) for t in texts]), 1)
    finish(jobs.order_detail_job(messages, sku, details, f"{work}/out", f"{work}/cp"), 300)
    assert kept and set(map(tuple, kept)) == {("id",)}
    assert rows(details.read(), "id", "spu_id", "spu_name") == [(1, 2, "spu"), (2, 0, None)]
    assert rows(spark.read.parquet(f"{work}/out"), "key") == [("1",), ("2",)]


def test_a_table_of_one_batch_is_read_without_a_shuffle(spark, plan, rows):
    keyed = KeyedTable(spark, work_dir(spark, "one"), schemas.rows("id bigint, v string"), ["id"])
    new = lambda v: spark.range(100).select("id", F.lit(v).alias("v"))
    keyed.upsert(new("a").union(new("b")), 0, ["v"])
    assert "Exchange" not in plan(keyed.read()) and set(rows(keyed.read(), "v")) == {("b",)}
    keyed.upsert(new("c"), 1, [])
    assert "Exchange" in plan(keyed.read()) and len(rows(keyed.read())) == 100 and set(rows(keyed.read(), "v")) == {("c",)}
    keyed.compact(before=2)
    assert "Exchange" not in plan(keyed.read()) and len(rows(keyed.read())) == 100
