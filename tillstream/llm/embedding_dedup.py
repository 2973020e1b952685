"""Operator 1: near-duplicate embeddings.

Sign hashing by random hyperplanes in several tables finds candidates, the
exact cosine in double precision decides, and connected components join what
is linked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm.components import components
from tillstream.llm.tables import kept, read_table
from tillstream.llm.vectors import packed, unit, unpack


def table_plan(rows: int, threshold: float, miss: float = 1e-4, bucket: int = 200) -> tuple[int, int]:
    """(bits, tables): about ``bucket`` unrelated vectors in a bucket, and a
    pair exactly at ``threshold`` kept apart in all tables with probability ``miss`` at most."""
    bits = max(8, math.ceil(math.log2(max(rows, 1) / bucket)))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-together))


def planes(size: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, tables * bits))


def codes(matrix: np.ndarray, normals: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """One code per vector and table: the signs of its projections."""
    signs = (unit(matrix) @ normals > 0).reshape(len(matrix), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def least_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For the nodes 0 to n-1 of a small graph: the least node of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            return root


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of successive batches, sorted by their first ``keys`` columns, as one table per key."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        if not len(table):
            continue
        stacked = np.stack([table.column(i).to_numpy() for i in range(keys)])
        ends = np.flatnonzero((stacked[:, 1:] != stacked[:, :-1]).any(0)) + 1
        begin = 0
        for end in ends:
            yield table.slice(begin, end - begin)
            begin = end
        rest = table.slice(begin)
    if rest is not None and len(rest):
        yield rest


def link(
    table: DataFrame, threshold: float = 0.9, miss: float = 1e-4, block: int = 128, seed: int = 1
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``table``.

    Two vectors are linked if their cosine is at least ``threshold``. Vectors
    that are null, empty, zero or hold null or non-finite components, vectors
    of different lengths, and rows without a vec_id link with nothing. Equal
    vectors stand for one another and are compared once; n_links counts rows,
    so a repeated row counts as often as it occurs. Rows that share a vec_id
    are one node of the graph, whatever their vectors are, and each of them has the
    links of its own vector. An empty table gives an empty result. Columns
    other than vec_id and embedding are not read.

    No pair becomes a row. A bucket is compared by matrix products in blocks of
    ``block`` vectors, each pair of blocks of a large bucket in a place of its
    own, and yields only counts and a spanning forest. A pair that meets in
    several tables counts in the first.
    """
    base = kept(packed(table), "vectors")
    valid = base.where(F.col("vec").isNotNull() & F.col("vec_id").isNotNull())
    reps = valid.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    reps = kept(reps.withColumn("node", F.xxhash64("rep", "vec")), "distinct")
    bits, tables = table_plan(reps.count(), threshold, miss)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(v.as_py()) // 8 for v in batch.column(3)], int)
            buckets = np.zeros((len(batch), tables), np.int64)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                own = codes(unpack(batch.column(3).take(pa.array(at))), planes(d, tables, bits, seed), tables, bits)
                buckets[at] = (own << 24 | np.arange(tables)) * 65537 + d
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(batch) + 1) * tables, pa.int32()), pa.array(buckets.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["node", "rep", "weight", "vec", "buckets"])

    rows = (
        reps.select("node", "rep", "weight", "vec")
        .mapInArrow(hashed, "node long, rep long, weight long, vec binary, buckets array<long>")
        .select("node", "rep", "weight", "vec", F.posexplode("buckets").alias("tab", "bucket"))
    )
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.col("node"), parts.cast("long")).cast("int")
    met = rows.join(sizes, "bucket").withColumn("part", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "bucket",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        "part",
        "tab",
        "node",
        "rep",
        "weight",
        "vec",
    )
    met = met.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals: dict[int, np.ndarray] = {}
        out: list[tuple[np.ndarray, ...]] = []
        held = 0
        for run in runs(batches, 3):
            if len(run) < 2:
                continue
            matrix = unit(unpack(run.column("vec")))
            i, j = run.column("i")[0].as_py(), run.column("j")[0].as_py()
            part = run.column("part").to_numpy()
            found = matrix @ matrix.T >= threshold
            found &= np.triu(np.ones_like(found), 1) if i == j else (part == i)[:, None] & (part == j)[None, :]
            left, right = np.nonzero(found)
            if not len(left):
                continue
            rep, weight = run.column("rep").to_numpy(), run.column("weight").to_numpy()
            first = np.ones(len(left), bool)
            if tab := run.column("tab")[0].as_py():
                d = matrix.shape[1]
                if d not in normals:
                    normals[d] = planes(d, tables, bits, seed)
                own = codes(unpack(run.column("vec")), normals[d], tables, bits)[:, :tab]
                first = ~(own[left] == own[right]).any(1)
            links = np.zeros(len(run), np.int64)
            np.add.at(links, left[first], weight[right[first]])
            np.add.at(links, right[first], weight[left[first]])
            root = rep[least_roots(len(run), left, right)]
            say = (links > 0) | (root != rep)
            out.append((run.column("node").to_numpy()[say], rep[say], links[say], root[say]))
            held += int(say.sum())
            if held > 50_000:
                yield joined(out)
                out, held = [], 0
        if out:
            yield joined(out)

    def joined(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
        return pa.RecordBatch.from_arrays(columns, ["node", "rep", "links", "root"])

    seen = kept(met.mapInArrow(compared, "node long, rep long, links long, root long"), "links")
    counts = seen.groupBy("node").agg(F.sum("links").alias("links"))
    # The vectors of one vec_id are one node: their representatives are tied.
    own = valid.join(reps, "vec").select("vec_id", "rep")
    least = own.groupBy("vec_id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least <> most")
    tied = own.join(least, "vec_id").where("rep <> least").select("rep", F.col("least").alias("root"))
    groups = components(seen.where("rep <> root").select("rep", "root").union(tied).distinct())
    named = (
        reps.join(counts, "node", "left")
        .join(groups, reps["rep"] == groups["node"], "left")
        .select("vec", "weight", F.coalesce("component", "rep").alias("component_id"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    linked = valid.join(named, "vec").select(
        "vec_id", (F.col("links") + F.col("weight") - 1).cast("long").alias("n_links"), "component_id"
    )
    alone = base.where(F.col("vec").isNull() | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_embedding_dedup": op1_embedding_dedup}
