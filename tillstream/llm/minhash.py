"""Operator 8: near-duplicate documents by SetSketch registers.

Sketch. A document's set is its distinct word shingles. Each register keeps the
least of exponentially distributed hashes of the set's elements on an
exponential scale, truncated to integers: max(0, min(q + 1, 1 - log_b least)),
rounded down. Registers of a union are maxima of registers, and the chance that
two documents share a register grows with their similarity.

Candidates. Documents that share all registers of a band meet in its bucket.
In a bucket all are compared with one member, the one whose buckets hold most
documents, as an original has more near neighbours than its copies. The pair's
similarity is estimated from both sketches together by maximum likelihood; what
is clearly below the threshold goes. The rest is verified on the full sets.

The rest of a bucket. Copies of an original need not be near to each other, so
members that stay apart after that are compared exactly by their rarest
shingles: two sets above the threshold must share one of the first
n - ceil(t n) + 1 of theirs, in the order of rarity. So no link is lost to the
choice of the member, no group is expanded into all its pairs, and documents
whose links are settled take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm.components import components
from tillstream.llm.packing import mixed
from tillstream.llm.tables import kept, read_table

REGISTERS, ROWS, WIDTH = 144, 6, 5
#: The most that a pair exactly at the threshold may share no band with.
MISS = 2e-5
#: Sketch parameters: base, rate and the largest value less 1.
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2
#: Odd multipliers, one hash function per register.
FACTORS = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: bytes, width: int = WIDTH, known: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; of all words, if there are fewer; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = {} if known is None else known
    for word in set(words).difference(known):
        known[word] = xxhash.xxh64_intdigest(word)
    hashes = np.array([known[w] for w in words], np.uint64)
    runs = max(1, len(hashes) - width + 1)
    total = np.full(runs, len(words) if len(words) < width else width, np.uint64)
    for i in range(min(width, len(hashes))):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + runs])
    return np.unique(total)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The registers of a set that is not empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for begin in range(0, len(elements), 512):
        hashes = elements[begin : begin + 512, None] * FACTORS
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, hashes.min(0), out=least)
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / math.log(BASE)), 0, LIMIT + 1).astype("<u2")


def band_rows(threshold: int) -> int:
    """The most registers a band may have so that a pair exactly at ``threshold`` misses all bands with ``MISS`` at most."""
    for rows in range(REGISTERS, 1, -1):
        if (1 - (threshold / 100) ** rows) ** (REGISTERS // rows) <= MISS:
            return rows
    return 1


def band_keys(registers: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash of each band of ``rows`` registers of a sketch, which differs between bands; an incomplete last one is left out."""
    bands = registers[: len(registers) // rows * rows].astype(np.uint64).reshape(-1, rows)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for i in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, i])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The most likely Jaccard similarity of pairs of sketches (rows of a and b) of sets of known sizes.

    A register of one is larger than the other's with probability
    p(share of one - J * share of the other), p(x) = -log_b(1 - x (b - 1) / b).
    The likelihood has one peak, found by ternary search.
    """
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)

    def larger(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.maximum(x, 0.0) * (BASE - 1) / BASE) / math.log(BASE), 1e-12)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = larger(u - v * j), larger(v - u * j)
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(40):
        x, y = low + (high - low) / 3, high - (high - low) / 3
        rising = likelihood(x) < likelihood(y)
        low, high = np.where(rising, x, low), np.where(rising, high, y)
    return (low + high) / 2


def sketched(docs: DataFrame, band: int = ROWS) -> DataFrame:
    """(doc_id, n, node, registers, keys): size, 128-bit fingerprint, sketch and band keys of each document's set."""
    names = ["doc_id", "n", "node", "registers", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        done: dict[bytes, tuple[bytes, np.ndarray]] = {}
        for batch in batches:
            sizes, prints, registers, keys = [], [], [], []
            for text in batch.column(1).cast(pa.binary()):
                if len(words) > 100_000:
                    words.clear()
                if len(done) > 5_000:
                    done.clear()
                elements = shingles(text.as_py() or b"", known=words)
                sizes.append(len(elements))
                mark = xxhash.xxh128_digest(elements.tobytes()) if len(elements) else None
                prints.append(mark)
                if mark is not None and mark not in done:
                    own = sketch(elements)
                    done[mark] = (own.tobytes(), band_keys(own, band))
                own_registers, own_keys = done[mark] if mark is not None else (None, None)
                registers.append(own_registers)
                keys.append(own_keys)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(prints, pa.binary()),
                pa.array(registers, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return kept(rows.mapInArrow(run, "doc_id long, n long, node binary, registers binary, keys array<long>"), "sketches")


def likely(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose estimated similarity is at least ``least``."""
    own = reps.select("node", "n", "registers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(len(batch), -1) for i in (3, 5))
            found = estimate(a, b, batch.column(2).to_numpy(), batch.column(4).to_numpy())
            yield batch.select(["a", "b"]).filter(pa.array(found >= least))

    both = (
        pairs.join(own.toDF("a", "na", "ra"), "a")
        .join(own.toDF("b", "nb", "rb"), "b")
        .select("a", "b", "na", "ra", "nb", "rb")
    )
    return both.mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= ``threshold`` * union holds for the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= threshold * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(sets.toDF("a", "ea"), "a").join(sets.toDF("b", "eb"), "b").select("a", "b", "ea", "eb")
    return kept(both.mapInArrow(run, "a binary, b binary"), "links")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, elements): the sorted shingle hashes of the sets ``wanted`` (node, rep), from the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        for batch in batches:
            made = []
            for text in batch.column(1).cast(pa.binary()):
                if len(words) > 100_000:
                    words.clear()
                made.append(shingles(text.as_py() or b"", known=words).tobytes())
            # A repeated id may stand for several texts: the one whose set is wanted counts.
            right = [xxhash.xxh128_digest(m) == node for m, node in zip(made, batch.column(0).to_pylist())]
            found = pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "elements"])
            yield found.filter(pa.array(right, pa.bool_()))

    texts = docs.selectExpr("cast(doc_id as long) rep", "text").join(wanted, "rep").select("node", "text")
    return kept(texts.mapInArrow(run, "node binary, elements binary").dropDuplicates(["node"]), "sets")


def rare_pairs(sets: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """Pairs of ``members`` (node, component) in different components that share a shingle which each must show.

    The shingles of a set stand in the order of their frequency among the members; see the module's text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), "<i8") for x in batch.column(2)]
            offsets = np.cumsum([0, *map(len, own)])
            flat = np.concatenate(own) if own else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["node", "component", "elements"])

    rows = (
        members.join(sets, "node")
        .select("node", "component", "elements")
        .mapInArrow(run, "node binary, component binary, elements array<long>")
        .select("node", "component", F.size("elements").alias("n"), F.explode("elements").alias("element"))
    )
    often = rows.groupBy("element").agg(
        F.count("*").alias("f"), (F.min("component") != F.max("component")).alias("shared")
    )
    order = F.struct("f", "element", "shared")
    ranked = rows.join(often, "element").groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(order)).alias("order"))
    # An intersection of at least t/100 of the union is at least t/100 of either set.
    show = F.col("n") - F.ceil(F.col("n") * threshold / 100).cast("int") + 1
    first = ranked.select("node", "component", "n", F.posexplode(F.slice("order", F.lit(1), show)).alias("i", "e"))
    # A shingle that is in one component alone makes no pair.
    first = first.where("e.shared").select("node", "component", (F.col("n") - F.col("i")).alias("rest"), "n", "e.element")
    first = kept(first, "prefixes")
    a, b = first.toDF("a", "ca", "ra", "na", "element"), first.toDF("b", "cb", "rb", "nb", "element")
    # At the first shingle that two sets share, in this order, the intersection lies in what is left of both.
    near = (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b"))
    near &= (100 + threshold) * F.least("ra", "rb") >= threshold * (F.col("na") + F.col("nb"))
    return a.join(b, "element").where(near).select("a", "b").distinct()


def named(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """``nodes`` with the component of each node, which is the node itself if ``groups`` does not have it."""
    found = groups.select("node", F.col("component").alias("component_"))
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component_", "node")).drop("component_")


def classes(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Words are runs of `[^\\x20\\x09-\\x0D]` with A-Z in lower case. Two documents
    are linked if 100 * intersection >= ``threshold`` * union of their sets of
    distinct 5-word shingles; with fewer words, the whole sequence is the one
    element. component_id is the smallest doc_id reachable by links. A text that
    is null or has no word has an empty set and links with nothing. Rows that
    repeat a doc_id are one node of the graph; a row without a doc_id links with
    nothing and is kept. Equal sets stand for one another, so exact copies are
    compared once. An empty table gives an empty result. Other columns are not
    read.

    The rows of a band follow from the threshold: a pair exactly at it shares no
    band with probability 1.2e-5 at 85 (24 bands of 6) and 1.5e-5 at 80 (28 of
    5); its estimate puts it out if it is 4 standard deviations off.
    """
    rows = sketched(docs, band_rows(threshold))
    able = rows.where(F.col("doc_id").isNotNull() & F.col("node").isNotNull())
    sets_of = able.groupBy("node").agg(F.min("doc_id").alias("rep"))
    reps = able.join(sets_of, "node").where("doc_id = rep").dropDuplicates(["node"])
    reps = kept(reps.select("node", "rep", "n", "registers", "keys"), "representatives")

    bands = reps.select("node", F.explode("keys").alias("key"))
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = kept(bands.join(sizes, "key"), "buckets")
    weighed = members.join(members.groupBy("node").agg(F.sum("size").alias("weight")), "node")
    weighed = kept(weighed.select("key", "node", "weight"), "weighed")
    heads = weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("head"))
    stars = weighed.join(heads, "key").where("node <> head.node")
    stars = stars.select(F.col("node").alias("a"), F.col("head.node").alias("b")).distinct()

    similar = threshold / 100
    least = similar - 4 * math.sqrt(similar * (1 - similar) / REGISTERS)
    candidates = kept(likely(stars, reps, least), "candidates")
    # Buckets of two are compared whole by now; the members of larger ones may still have to be.
    wanted = candidates.select(F.col("a").alias("node")).union(candidates.select("b"))
    wanted = wanted.union(members.where("size > 2").select("node")).distinct()
    sets = full_sets(docs, reps.join(wanted, "node", "left_semi").select("node", "rep"))
    links = verified(candidates, sets, threshold)

    placed = kept(named(members.where("size > 2").select("key", "node"), components(links)), "placed")
    ends = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = placed.join(ends.where("x <> y"), "key", "left_semi").select("node", "component").distinct()
    more = verified(likely(rare_pairs(sets, open_, threshold), reps, least), sets, threshold)

    several = able.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    tied = able.join(several.select("doc_id", "a"), "doc_id").where("node <> a").select("a", F.col("node").alias("b"))
    groups = named(sets_of, components(links.union(more).union(tied)))
    least_id = groups.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = kept(groups.join(least_id, "component").select("node", "component_id"), "classes")
    linked = able.select("doc_id", "n", "node").join(found, "node").select("doc_id", "n", "component_id")
    alone = rows.where(F.col("doc_id").isNull() | F.col("node").isNull())
    alone = alone.select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.union(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def deduplicated(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """The documents, with all columns, of which one of each group of near-duplicates stays: the smallest doc_id.

    Rows that repeat a doc_id share its fate; rows without a doc_id stay. Other columns may have any names.
    """
    gone = classes(docs, threshold).where("not kept").select("doc_id").distinct()
    return docs.alias("own").join(gone.alias("gone"), F.col("own.doc_id") == F.col("gone.doc_id"), "left_anti")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read_table(spark, sf_dir, "documents"))


QUERIES = {"op8_minhash_dedup": op8_minhash_dedup}
