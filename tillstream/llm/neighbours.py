"""Operator 2: approximate nearest neighbours by counting collisions.

Vectors are projected on single random lines. For each line a block of vectors
has a sorted array of projections; a query opens a window around its own
projection on every line and widens the windows step by step (virtual
rehashing). A vector that lies in enough windows is verified by its exact
cosine. A query stops widening when its k-th best verified distance is within
the radius that the windows stand for, or when it has verified its share of the
block; those in most windows come first, and vectors that are in equally many
are verified together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillstream.llm.tables import kept, read_table
from tillstream.llm.vectors import packed, unit, unpack

#: A window is this many radii wide to each side; a vector at the radius is in it with probability 0.71.
HALF = 1.05
#: A query verifies this many vectors of a block, however small its share of it.
FEWEST = 100


class Lines:
    """Sorted projections of one block of vectors."""

    def __init__(self, matrix: np.ndarray, lines: int, seed: int):
        directions = np.random.default_rng([seed, matrix.shape[1]]).standard_normal((matrix.shape[1], lines))
        self.matrix, self.directions = matrix, directions
        spots = (unit(matrix) @ directions).T
        self.order = np.argsort(spots, axis=1, kind="stable")
        self.sorted = np.take_along_axis(spots, self.order, axis=1)
        self.norms = np.sqrt((matrix * matrix).sum(1))

    def windows(self, queries: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) in the sorted arrays of each query's window on each line; rows are queries."""
        spots = (unit(queries) @ self.directions).T
        low = [np.searchsorted(s, p - HALF * radius) for s, p in zip(self.sorted, spots)]
        high = [np.searchsorted(s, p + HALF * radius, "right") for s, p in zip(self.sorted, spots)]
        return np.array(low).T, np.array(high).T

    def steps(
        self, queries: np.ndarray, radius: float, growth: float
    ) -> Iterator[Iterator[tuple[float, np.ndarray, np.ndarray]]]:
        """For each query the radii with its windows; the last radius is above 2 and needs none."""
        radii, none = [], np.zeros((len(queries), 0), int)
        while radius <= 2.0:
            radii.append((radius, *self.windows(queries, radius)))
            radius *= growth
        radii.append((radius, none, none))
        for i in range(len(queries)):
            yield ((r, begin[i], end[i]) for r, begin, end in radii)

    def search(
        self, query: np.ndarray, k: int, barred: np.ndarray, ids: np.ndarray, collide: float, share: float,
        steps: Iterator[tuple[float, np.ndarray, np.ndarray]],
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and cosines of the k nearest found, nearest first, ties to smaller ids, and how many were verified.

        ``barred`` rows take no part. ``steps`` gives ever larger radii with the query's windows, and at last one that
        holds everything.
        """
        lines, n = self.order.shape
        counts = np.zeros(n, np.int64)
        checked, need = barred.copy(), int(np.ceil(collide * lines))
        room, verified = k + max(FEWEST, int(share * n)), 0
        rows, scores = np.zeros(0, int), np.zeros(0)
        norm = np.sqrt((query * query).sum())
        low: list[int] | None = None
        high: list[int] | None = None
        for radius, begin, end in steps:
            everything = radius > 2.0
            if not everything:
                begin, end = begin.tolist(), end.tolist()
                if low is None or high is None:
                    spans = [o[a:b] for o, a, b in zip(self.order, begin, end)]
                else:
                    spans = [o[a:b] for o, a, b in zip(self.order, begin, low)]
                    spans += [o[a:b] for o, a, b in zip(self.order, high, end)]
                low, high = begin, end
                counts += np.bincount(np.concatenate(spans), minlength=n)
            new = np.flatnonzero(~checked if everything else (counts >= need) & ~checked)
            if not everything and len(new) > room - verified:
                level = np.partition(counts[new], verified - room)[verified - room]
                new = new[counts[new] >= level]
            if len(new):
                checked[new] = True
                verified += len(new)
                # Row by row, so that equal vectors have equal cosines wherever they stand.
                cosine = (self.matrix[new] * query).sum(1) / (self.norms[new] * norm)
                rows, scores = np.concatenate([rows, new]), np.concatenate([scores, cosine])
                best = np.lexsort((ids[rows], -scores))[:k]
                rows, scores = rows[best], scores[best]
            if len(rows) == k and (verified >= room or 2 - 2 * scores[-1] <= radius * radius):
                break
        return rows, scores, verified


def nearest(
    table: DataFrame,
    queries: DataFrame,
    k: int = 5,
    lines: int = 128,
    collide: float = 0.6,
    share: float = 0.2,
    radius: float = 0.55,
    growth: float = 1.4,
    block: int = 8192,
    query_block: int = 1024,
    seed: int = 2,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of ``table`` by cosine for every row of ``queries``.

    Both tables have columns vec_id and embedding. A row of the query's own
    vec_id is no candidate. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows without a vec_id, take no part; vectors of
    another length than the query's are no candidates. Equal scores go to the
    smaller vec_id; a repeated row is a candidate each time. Equal rows of
    ``queries`` are one query; a vec_id with several vectors is answered for each of
    them, with ranks of its own. With fewer than k candidates all are returned; empty
    tables give an empty result.

    Queries and vectors are both dealt out in blocks by a hash and each pair of
    blocks is searched in a place of its own, so neither side is ever held
    whole; the k best of each block are merged. ``lines``, ``collide`` and
    ``share`` set the recall: a vector at the final radius is in a line's window
    with probability 0.71 and is verified if it is in the share ``collide`` of
    its windows. A query that finds nothing near stops at the share ``share`` of a
    block (at least 100 vectors and k), where vectors in equally many windows,
    so all copies of one vector, are verified or left together.
    """
    valid = F.col("vec").isNotNull() & F.col("vec_id").isNotNull()
    data = kept(packed(table).where(valid), "candidates")
    asked = kept(packed(queries).where(valid).dropDuplicates(["vec_id", "vec"]), "queries")
    blocks = max(1, -(-data.count() // block))
    query_blocks = max(1, -(-asked.count() // query_block))

    def dealt(df: DataFrame, own: int, others: int, is_query: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        a, b = (every, mine) if is_query else (mine, every)
        columns = {"block": a, "query_block": b}
        first = "query_block" if is_query else "block"
        df = df.withColumn(first, columns.pop(first))
        for name, column in columns.items():
            df = df.withColumn(name, column)
        size = F.octet_length("vec")
        return df.select("block", "query_block", size.alias("size"), F.lit(is_query).alias("asks"), "vec_id", "vec")

    both = dealt(data, blocks, query_blocks, False).union(dealt(asked, query_blocks, blocks, True))

    def searched(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        ids = group.column("vec_id").to_numpy()
        found: list[tuple[int, int, int, float]] = []
        if asks.any() and not asks.all():
            matrix = unpack(group.column("vec"))
            own = ids[~asks]
            index = Lines(matrix[~asks], lines, seed)
            searches = index.steps(matrix[asks], radius, growth)
            vectors = group.column("vec").filter(pa.array(asks)).to_pylist()
            marks = [int.from_bytes(hashlib.blake2b(v, digest_size=8).digest(), "little", signed=True) for v in vectors]
            for i, (query_id, query, steps) in enumerate(zip(ids[asks], matrix[asks], searches)):
                rows, scores, _ = index.search(query, k, own == query_id, own, collide, share, steps)
                found += zip([query_id] * len(rows), [marks[i]] * len(rows), own[rows], scores)
        columns = list(zip(*found)) or [[], [], [], []]
        return pa.table(
            {
                "query_id": pa.array(np.array(columns[0], np.int64)),
                "mark": pa.array(np.array(columns[1], np.int64)),
                "vec_id": pa.array(np.array(columns[2], np.int64)),
                "score": pa.array(np.array(columns[3], np.float64)),
            }
        )

    found = both.groupBy("block", "query_block", "size").applyInArrow(
        searched, "query_id long, mark long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return nearest(table, table.where("vec_id % 50 = 0"))


QUERIES = {"op2_neighbours": op2_neighbours}
