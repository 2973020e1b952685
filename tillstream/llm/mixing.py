"""Operator 5: mix sources to target weights.

Every source gets a budget of words. Its documents are put in the order of a
random hash, running totals of their sizes are taken, and the order is cut at
the budget: whole passes (epochs) first, then a part of one more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.llm.ranks import hash_bucket, ranked, running_total
from tillstream.llm.tables import joined_small, kept, read_table

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def placed(docs: DataFrame, seed: int, *extra: Column) -> DataFrame:
    """The place of each document in the order of its source.

    ``src`` is the source as a key that is never null ('v' and the name, or
    'n'); rows with the same id and text share a place.
    """
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    return docs.select(
        *extra,
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), "source")).alias("src"),
        word_count(F.col("text")).alias("size"),
        F.struct(
            key.alias("key"), F.col("doc_id").alias("id"), F.crc32(F.coalesce("text", F.lit(""))).alias("crc")
        ).alias("place"),
    )


def targets(sized: DataFrame, weights: tuple[float, ...], share: float, most: float, least: float) -> DataFrame:
    """(src, total, target): each source's budget of words.

    Sources in code point order, null last, take ``weights`` in turn. ``least``
    times its size is a source's own; the rest of ``share`` times all sizes
    goes out by weight. No target passes ``most`` times the source's size; what
    is above is shared again by weight among the others until none is above.
    Each round sends two sums to the driver, whatever the number of sources.
    """
    totals = sized.groupBy("src").agg(F.sum("size").alias("total"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    named = ranked(totals, [F.when(F.col("src") == "n", 1).otherwise(0), F.col("src")], "turn")
    weighed = kept(
        named.select("src", "total", F.get(turn, (F.col("turn") % len(weights)).cast("int")).alias("weight")),
        "sources",
    )
    room = F.col("total") * F.lit(most - least)
    whole = weighed.agg(F.sum("total")).first()[0] or 0
    pot, full, level = whole * (share - least), -1, 0.0
    while True:
        open_ = room > F.col("weight") * F.lit(level)
        got = weighed.agg(
            F.sum(F.when(~open_, room)), F.sum(F.when(open_, F.col("weight"))), F.sum((~open_).cast("int"))
        ).first()
        if not got[1] or got[2] == full:
            break
        full, level = got[2], max(level, (pot - (got[0] or 0.0)) / got[1])
    return weighed.select(
        "src", "total", (F.col("total") * F.lit(least) + F.least(room, F.col("weight") * F.lit(level))).alias("target")
    )


def cuts(sized: DataFrame, goals: DataFrame, bits: int = 12) -> DataFrame:
    """Adds to ``goals`` where each source's order is cut.

    ``epochs`` whole passes, then one more that takes all before ``cut`` and
    ``at_cut`` words of what stands there. 2**bits ranges of the hash carry the
    running totals of one source, so a source with a third of all rows is
    summed up by many tasks.
    """
    epochs = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn(
        "left", F.floor(F.col("target") - F.col("epochs") * F.col("total")).cast("long")
    )
    goals = kept(goals, "goals")
    # All rows of a place at once: the cut shares what is left among them, also those behind the budget.
    places = sized.groupBy("src", "place", "size").agg(F.count("*").alias("n"))
    spread = places.withColumn("bucket", hash_bucket(F.col("place.key"), bits)).withColumn("words", F.col("size") * F.col("n"))
    summed = running_total(spread, ["src"], "bucket", ["place", "size"], "words", "before")
    inside = joined_small(summed, goals.select("src", "left"), "src").where(F.col("before") < F.col("left"))
    last = inside.groupBy("src").agg(F.max(F.struct("place", "before", "n", "left")).alias("end"))
    at_cut = F.floor((F.col("end.left") - F.col("end.before")) / F.col("end.n")).cast("long")
    last = last.select("src", F.col("end.place").alias("cut"), at_cut.alias("at_cut"))
    return kept(goals.join(last, "src", "left").drop("left"), "cuts")


def taken() -> Column:
    """Words that the mix takes of a document, repeats counted."""
    part = (
        F.when(F.col("cut").isNull() | (F.col("place") > F.col("cut")), F.lit(0))
        .when(F.col("place") == F.col("cut"), F.least("size", "at_cut"))
        .otherwise(F.col("size"))
    )
    return (F.col("epochs") * F.col("size") + part).cast("long")


def allocate(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    least: float = 0.0,
    seed: int = 5,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``.

    Needs columns doc_id, text and source; other columns are not read. A null
    text has size 0; null sources are one source; an empty table gives an empty
    result. Rows of the same id and text are interchangeable: if the cut falls
    on k such rows, each gets the k-th part, rounded down. The order depends on
    the rows and ``seed`` alone, so reruns agree.
    """
    sized = kept(placed(docs, seed, F.col("doc_id")), "sized")
    plan = cuts(sized, targets(sized, weights, share, most, least))
    return joined_small(sized, plan, "src").select(
        "doc_id", "size", F.col("total").alias("source_size"), "target", taken().alias("taken")
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    least: float = 0.0,
    seed: int = 5,
) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A document stands once per whole epoch; where the cut falls on it, one more
    row has the text up to the budget's last word, its words set apart by one
    space. Texts are not shuffled: the cuts, one row per source, are joined to
    the documents. Documents without words cost nothing and stand once.
    """
    columns = docs.columns
    sized = kept(placed(docs, seed), "sized")
    plan = cuts(sized, targets(sized, weights, share, most, least))
    rows = placed(docs, seed, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    rows = joined_small(rows, plan, "src")
    part = taken() - F.col("epochs") * F.col("size")
    copies = (
        F.when(F.col("size") == 0, F.lit(1))
        .otherwise(F.col("epochs") + F.when(part > 0, 1).otherwise(0))
        .cast("int")
    )
    rows = rows.select(
        "row", "size", part.alias("part"), "epochs", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(0)))).alias("turn"),
        copies.alias("copies"),
    ).where(F.col("turn").between(1, F.col("copies")))
    cut = (F.col("turn") > F.col("epochs")) & (F.col("part") < F.col("size")) & (F.col("size") > 0)
    words = F.slice(F.split(F.ltrim(F.regexp_replace("row.text", r"[\x20\x09-\x0D]+", " ")), " "), 1, F.col("part").cast("int"))
    text = F.when(cut, F.array_join(words, " ")).otherwise(F.col("row.text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocate(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_mixing": op5_mixing}
