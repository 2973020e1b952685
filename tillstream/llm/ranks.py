"""Running totals and ranks over tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.tables import kept


def hash_bucket(key: Column, bits: int) -> Column:
    """The range, one of 2**bits, that a uniform 64-bit hash lies in; ranges stand in the order of the keys."""
    return F.shiftright(key, 64 - bits)


def running_total(df: DataFrame, by: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one within ``by``.

    Rows stand in the order of ``bucket``, then of ``order``. Totals of
    (by, bucket) are summed first, so no window holds a whole group: one runs
    over the buckets of a group, the other over the rows of one bucket. ``by``
    and ``bucket`` must not be null.
    """
    keys = [*by, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(offsets, keys)
        .withColumn(out, F.col("_o") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_o")
    )


def ranked(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds ``out``: the place of the row, from 0, in ``order``, which must be total.

    The rows are dealt out by range and written once, so the ranges can't
    change between counting and ranking; counts per range give the offsets.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = kept(
        df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    counts = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return (
        spread.join(offsets, "_part")
        .withColumn(out, F.col("_o") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
        .drop("_o", "_part")
    )
