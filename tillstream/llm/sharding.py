"""Operator 7: pack indivisible groups of rows into shards by best-fit decreasing.

Groups of at least one quantum (a fixed part of a shard) are packed one by one.
Smaller groups are first strung together, in the order of decreasing size, into
lots of about a quantum, because what is packed must be few enough for one
small task: at most ``2 * fine`` items a shard, whatever the number of groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillstream.llm.ranks import hash_bucket, running_total
from tillstream.llm.tables import kept, read_table


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; ``sizes`` must be decreasing.

    The bins' free room is kept in order, and a search finds the tightest one
    that still takes the item; a new bin is opened if there is none. An item
    above the capacity gets a bin of its own.
    """
    free: list[tuple[int, int]] = []
    bins, opened = [], 0
    for size in sizes:
        at = bisect_left(free, (size, -1))
        room, bin_ = free.pop(at) if at < len(free) else (max(capacity, size), opened)
        opened += bin_ == opened
        insort(free, (room - size, bin_))
        bins.append(bin_)
    return bins


def level_fit(sizes: list[int], bins: int) -> list[int]:
    """Best fit into a given number of bins, at the least capacity found by halving the range."""
    low = max(-(-sum(sizes) // bins), max(sizes, default=0))
    high = low + max(sizes, default=0) + 1
    best = None
    while low <= high:
        middle = (low + high) // 2
        found = best_fit(sizes, middle)
        if max(found, default=0) < bins:
            best, high = found, middle - 1
        else:
            low = middle + 1
    return best if best is not None else [i % bins for i in range(len(sizes))]


def pack(
    groups: DataFrame,
    shards: int | None = None,
    capacity: int | None = None,
    fine: int = 256,
    cell_shards: int = 1024,
) -> DataFrame:
    """(grp, size) -> (grp, shard): shards from 0, no group divided.

    With ``shards`` the groups go to that many shards of least capacity, so
    their sizes are near equal unless one group alone is above the mean. With
    ``capacity`` as few shards as best fit needs are opened; a group above it
    has a shard of its own. Many shards are packed in cells of ``cell_shards``
    by the groups' hash, so that no task gets more than
    ``2 * fine * cell_shards`` items. ``grp`` must be unique and not null; ties
    in size are told apart by the hash of ``grp``. An empty table gives none.
    """
    groups = groups.withColumn("key", F.xxhash64("grp"))
    total = groups.agg(F.sum("size")).first()[0] or 0
    cells = 1 if shards else max(1, -(-total // (capacity * cell_shards)))
    quantum = max(1, total // (shards * fine) if shards else capacity // fine)
    celled = groups.withColumn("cell", F.pmod(F.col("key"), F.lit(cells)).cast("int"))
    large = celled.where(F.col("size") >= quantum)
    # An eighth of a power of two is one class of sizes: largest first, then the hash, then the exact size.
    step = F.floor(F.log2(F.col("size").cast("double")) * 8).cast("int")
    small = celled.where(F.col("size") < quantum).withColumn(
        "band", F.concat(F.lpad((F.lit(999) - step).cast("string"), 3, "0"), F.lpad((hash_bucket("key", 8) + 128).cast("string"), 3, "0"))
    )
    strung = running_total(small, ["cell"], "band", ["key", "grp"], "size", "before").withColumn(
        "lot", F.floor(F.col("before") / quantum).cast("long")
    )
    strung = kept(strung.select("grp", "cell", "lot", "size"), "lots")
    items = large.select("cell", F.lit(None).cast("long").alias("lot"), "grp", "size").union(
        strung.groupBy("cell", "lot").agg(F.sum("size").alias("size")).select(
            "cell", "lot", F.lit(None).cast(groups.schema["grp"].dataType).alias("grp"), "size"
        )
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(order=pdf["grp"].map(lambda g: "" if g is None else bytes(g).hex()))
        pdf = pdf.sort_values(["size", "lot", "order"], ascending=[False, True, True]).drop(columns="order")
        sizes = [int(x) for x in pdf["size"]]
        return pdf.assign(shard=level_fit(sizes, shards) if shards else best_fit(sizes, capacity))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields)
    placed = kept(items.groupBy("cell").applyInPandas(fit, f"{fields}, shard long"), "packed")
    opened = placed.groupBy("cell").agg((F.max("shard") + 1).alias("n"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = opened.select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = placed.join(offsets, "cell").withColumn("shard", (F.col("shard") + F.col("first")).cast("int"))
    lots = placed.where(F.col("lot").isNotNull()).select("cell", "lot", "shard")
    return (
        placed.where(F.col("lot").isNull())
        .select("grp", "shard")
        .union(strung.join(lots, ["cell", "lot"]).select("grp", "shard"))
    )


def shard_documents(docs: DataFrame, shards: int | None = 16, capacity: int | None = None, bits: int = 11) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per row of ``docs``; equal texts share a shard.

    A size is the UTF-8 bytes of the text plus 1 (null: 1, with the crc of the
    empty text; null and empty texts are one group). Slots count from 0 in each
    shard without a gap, in the order of a hash of the row; rows that are equal
    in id and text are interchangeable. Columns other than doc_id and text are
    not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = kept(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("grp"),
        ),
        "rows",
    )
    packed = pack(rows.groupBy("grp").agg(F.sum("size").alias("size")), shards, capacity)
    placed = kept(
        rows.join(packed, "grp").select(
            "doc_id", "size", "text_crc32", "shard", F.xxhash64("doc_id", "grp").alias("key"), F.lit(1).alias("one")
        ),
        "placed",
    )
    placed = placed.withColumn("bucket", hash_bucket(F.col("key"), bits))
    return running_total(placed, ["shard"], "bucket", ["key", "doc_id", "text_crc32"], "one", "slot").select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op7_sharding": op7_sharding}
