"""Operator 11: document fingerprints by one-permutation MinHash.

Built from SQL functions alone. Every shingle of a text is hashed once; the
hash's first bits are its bin, and a bin keeps its least hash. An empty bin
takes the value of a bin that has one, each with the same chance, chosen by a
hash of the two bins only (optimal densification). Of every bin the low-order
bits are stored, and likeness takes off the agreement that is due to chance.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.llm.ranks import ranked
from tillstream.llm.tables import kept, read_table

#: Words in a shingle.
WORDS = 5
#: 2**BIN_BITS bins; BITS low-order bits of each are stored, two hexadecimal digits.
BIN_BITS, BITS = 7, 8
BINS = 1 << BIN_BITS
LOW = (1 << BITS) - 1
#: The bits of a hash that don't tell its bin.
REST = (1 << (64 - BIN_BITS)) - 1


def _once(df: DataFrame, name: str, column: Column, *keep: str) -> DataFrame:
    """Adds a column that is computed here, and not again in each expression that uses it."""
    return df.select(*keep, F.explode(F.array(column)).alias(name))


def _place(number: int) -> int:
    """The largest hash of a bin, which stands for an empty one."""
    return ((number - BINS // 2) << (64 - BIN_BITS)) + REST


#: Where an empty bin looks for a value: ATTEMPTS bins for each, drawn once by a seeded generator.
ATTEMPTS = 32
PROBES = np.random.default_rng(11).integers(0, BINS, (ATTEMPTS, BINS)).tolist()


def _numbers(values: list[int], kind: str) -> Column:
    """A constant array, written as one text: a literal for each number would make a large plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def fingerprinted(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the fingerprint of the column ``text``, 128 bins of 8 bits packed in 16 numbers.

    Words are what stands between runs of `[\\x20\\x09-\\x0D]`, in lower case; a
    shingle is five words, or all of them if there are fewer. A text that is null
    or has no word has an empty array. Equal texts have equal fingerprints,
    whatever the other columns are.

    An empty bin tries other bins in a fixed random order of its own until one has a
    value; after ``ATTEMPTS`` of them the one whose hash with it is least gives its own.
    """
    columns = [c for c in df.columns if c != out]
    assert not {c for c in columns if c.startswith("_op11_")}
    plain = F.btrim(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(plain != "", F.split(plain, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))
    df = _once(df, "_op11_words", words, *columns)
    df = _once(df, "_op11_words", F.transform("_op11_words", lambda w: F.xxhash64(w)), *columns)
    own = F.col("_op11_words")
    shingles = F.when(
        F.size(own) >= WORDS,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(own) - WORDS, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(WORDS)]),
        ),
    ).otherwise(F.array(F.xxhash64(own)))
    # With the largest hash of every bin among them, all bins have a least one.
    places = _numbers([_place(i) for i in range(BINS)], "bigint")
    df = _once(df, "_op11_hashes", F.when(F.size(own) > 0, F.concat(shingles, places)), *columns)
    df = df.select(*columns, F.sort_array("_op11_hashes").alias("_op11_hashes"))
    hashes = F.col("_op11_hashes")
    first = F.filter(
        hashes,
        lambda x, i: (i == 0) | (F.shiftrightunsigned(x.bitwiseXOR(F.get(hashes, i - 1)), 64 - BIN_BITS) != 0),
    )
    df = _once(df, "_op11_minima", first, *columns)
    rest, low = F.lit(REST).cast("bigint"), F.lit(LOW).cast("bigint")
    values = F.transform("_op11_minima", lambda x: F.when(x.bitwiseAND(rest) != rest, x))
    df = _once(df, "_op11_values", values, *columns)
    held = F.col("_op11_values")

    def stored(own: Column, i: Column) -> Column:
        tried = [F.get(held, F.get(_numbers(probes, "int"), i)) for probes in PROBES]
        drawn = F.array_min(F.transform(held, lambda x, j: F.when(x.isNotNull(), F.struct(F.xxhash64(i, j).alias("h"), x.alias("x")))))
        # Hashed with the bin, so that bins with one giver agree by chance each on its own.
        given = F.xxhash64(F.coalesce(*tried, drawn["x"]), i)
        return F.coalesce(own, given).bitwiseAND(low)

    df = _once(df, "_op11_bits", F.transform(held, stored), *columns)
    full, each = F.col("_op11_bits"), 64 // BITS

    def number(g: Column) -> Column:
        parts = [F.shiftleft(F.get(full, g * each + k), 64 - BITS * (k + 1)) for k in range(each)]
        return functools.reduce(lambda a, b: a.bitwiseOR(b), parts)

    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS // each - 1)), number)
    return _once(df, out, F.when(full.isNotNull(), packed).otherwise(F.array().cast("array<bigint>")), *columns)


def printed(fingerprint: Column) -> Column:
    """A fingerprint as hexadecimal digits, two for each bin; the empty one as an empty string."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 64 // 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common shingles, 0 to 1, of two fingerprints; 1 for two empty ones, 0 for one of them.

    Bins agree by chance with a probability of 1 / 256, which is taken off.
    """
    ones = F.lit(sum(1 << i for i in range(0, 64, BITS))).cast("bigint")

    def differing(sum_: Column, x: Column) -> Column:
        """Adds the bytes of ``x`` that are not zero: all bits of each are brought together in its lowest."""
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return sum_ + F.bit_count(x.bitwiseAND(ones))

    other = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), differing)
    chance = 1.0 / (LOW + 1)
    share = F.greatest(((F.lit(float(BINS)) - other) / float(BINS) - chance) / (1 - chance), F.lit(0.0))
    blank = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(blank, (F.size(a) == F.size(b)).cast("double")).otherwise(share)


def neighbours(docs: DataFrame) -> DataFrame:
    """(node, doc_id, n_chars, copies, place, take, total): the distinct (doc_id, text) in descending doc_id, from place 0.

    Rows without a doc_id stand last, rows of one doc_id in the order of their
    text's SHA-256. ``take`` is how many code points the row before gets from this one.
    """
    nodes = docs.groupBy("node", "doc_id", "n_chars", "digest").agg(F.count("*").alias("copies"))
    placed = kept(ranked(nodes, [F.col("doc_id").desc_nulls_last(), F.col("digest")], "place").drop("digest"), "places")
    total = max(placed.count(), 1)
    before = placed.select(((F.col("place") + 1) % total).alias("place"), F.floor(F.col("n_chars") / 2).alias("take"))
    return placed.join(before, "place").withColumn("total", F.lit(total))


def edited(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per row of ``docs``.

    The edited text of a document has its last floor(n_chars / 2) code points
    replaced by the first as many, or all, of the next document in descending
    doc_id; the first one follows the last. A null text is empty. Rows that repeat
    doc_id and text follow one another: all but the last of them have the same
    text next. An empty table gives an empty result, a table of one row is its own
    next. Other columns are not read.

    Texts are shuffled twice: whole, by their own row, and in halves, by the row
    that they make the edited text of. Repeated rows are brought down to one per
    task before the first shuffle.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    rows = rows.withColumn("node", F.concat_ws(":", "digest", F.col("doc_id").cast("string")))
    places = neighbours(rows.withColumn("n_chars", F.char_length("text").cast("long")))
    texts = rows.groupBy("node").agg(F.first("text").alias("text")).join(places, "node").drop("node")
    half = F.floor(F.col("n_chars") / 2)

    def start(length: Column) -> Column:
        return F.substring("text", F.lit(1), length.cast("int"))

    texts = fingerprinted(texts, "text", "fingerprint")
    again = F.when(F.col("copies") > 1, F.concat(start(F.col("n_chars") - half), start(half)))
    own = F.struct("doc_id", "n_chars", "copies", start(F.col("n_chars") - half).alias("head"), again.alias("again"))
    parts = texts.select(
        "fingerprint",
        F.inline(
            F.array(
                F.struct(F.col("place"), own.alias("own"), F.lit(None).cast("string").alias("given")),
                F.struct(
                    F.pmod(F.col("place") - 1, F.col("total")).alias("place"),
                    F.lit(None).cast("struct<doc_id:bigint,n_chars:bigint,copies:bigint,head:string,again:string>").alias("own"),
                    start(F.col("take")).alias("given"),
                ),
            )
        ),
    )
    mine = F.col("own").isNotNull()
    whole = (
        parts.repartition("place")
        .groupBy("place")
        .agg(
            F.first("own", True).alias("own"),
            F.first("given", True).alias("given"),
            F.first(F.when(mine, F.col("fingerprint")), True).alias("fingerprint"),
            F.first(F.when(~mine, F.col("fingerprint")), True).alias("next_fingerprint"),
        )
    )
    kinds = F.array(
        F.struct(
            F.lit(1).cast("long").alias("rows"),
            F.concat("own.head", "given").alias("edited"),
            F.col("next_fingerprint"),
        ),
        F.struct((F.col("own.copies") - 1).alias("rows"), F.col("own.again").alias("edited"), F.col("fingerprint").alias("next_fingerprint")),
    )
    cases = whole.select(
        "own.doc_id", "own.n_chars", "fingerprint", F.inline(F.filter(kinds, lambda k: k["rows"] > 0))
    )
    cases = fingerprinted(cases, "edited", "edited_fingerprint")
    return cases.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("fingerprint")).alias("fingerprint"),
        printed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"),
    ).drop("copy")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(read_table(spark, sf_dir, "documents"))


QUERIES = {"op11_fingerprints": op11_fingerprints}
