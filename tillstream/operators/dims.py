"""Dimension lookups and the dimension tables that are built with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstream.functions.dates import age_years
from tillstream.functions.labels import age_group, gender_label


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    columns: Mapping[str, str],
    keep_if_null: bool = False,
) -> DataFrame:
    """Left lookup of ``dim`` (one row per key): a hit sets ``columns``, a miss leaves the row's own values.

    ``columns`` maps a target column to a column of ``dim``. With ``keep_if_null``
    a hit with a null value does not overwrite. No broadcast is forced: Spark
    broadcasts ``dim`` when its measured size is below the threshold, and else
    joins by shuffle, where adaptive execution splits a hot key.
    """
    kind = df.schema[key].dataType
    picked = dim.select(
        F.col(dim_key).try_cast(kind).alias("_key"),
        F.lit(True).alias("_hit"),
        *[F.col(source).alias(f"_{target}") for target, source in columns.items()],
    ).where(F.col("_key").isNotNull())
    joined = df.join(picked, F.col(key) == F.col("_key"), "left")
    names = df.columns
    own = {c: F.col(c) if c in names else F.lit(None) for c in columns}
    if keep_if_null:
        found = {c: F.coalesce(F.col(f"_{c}"), own[c]) for c in columns}
    else:
        found = {c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(own[c]) for c in columns}
    names = names + [c for c in columns if c not in names]
    return joined.select(*[found[c].alias(c) if c in found else F.col(c) for c in names])


def as_of_lookup(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    dim_key: str,
    at: str,
    since: str,
    columns: Sequence[str],
    seconds: int = 3600,
    salts: int = 8,
) -> DataFrame:
    """Each fact with ``columns`` of the version of its dimension row that was valid at its time.

    ``versions`` may have many rows of a key; the one with the greatest ``since`` (a
    timestamp, as ``at``) not after ``at`` counts, of equal ones the one with the
    greatest ``columns`` in their order, which must be sortable. A fact without a
    key, a time or an earlier version gets nulls, and so does one whose version has
    nulls. Versions without a key or a time never count. Columns of the facts with
    the same names are replaced.

    Facts and versions are put in one order per key, range of ``seconds`` and salt, and
    the last version is carried along. What was valid when a range began comes from
    one row per key and range, so no task sees all facts of a hot key: a range of it
    is dealt to ``salts`` tasks, and only its versions are copied to each. A key with
    many facts in a range calls for fewer ``seconds``.
    """
    salted = F.xxhash64(*facts.columns)
    slot = lambda time: F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (seconds * 1_000_000))
    kind = facts.schema[key].dataType
    asked = facts.select(
        F.col(key).alias("_key"),
        slot(at).alias("_slot"),
        # Facts that cannot match have no order to keep: they are spread more widely.
        F.pmod(salted, F.when(F.col(key).isNull() | F.col(at).isNull(), 1024).otherwise(salts)).cast("int").alias("_salt"),
        F.col(at).cast("timestamp").alias("_at"),
        F.lit(2).alias("_kind"),
        F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"),
    )
    known = versions.select(
        F.col(dim_key).try_cast(kind).alias("_key"),
        slot(since).alias("_slot"),
        F.col(since).cast("timestamp").alias("_at"),
        F.struct(*[F.col(c) for c in columns]).alias("_value"),
    ).where(F.col("_key").isNotNull() & F.col("_at").isNotNull())

    # At most ``salts`` numbers a range: a range with few facts gets few copies.
    valid = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    ranges = asked.where(valid).groupBy("_key", "_slot").agg(F.collect_set("_salt").alias("_salts"))
    latest = known.groupBy("_key", "_slot").agg(F.max(F.struct("_at", "_value")).alias("_last"))
    both = latest.unionByName(ranges, allowMissingColumns=True)
    per_range = both.groupBy("_key", "_slot").agg(F.max("_last").alias("_last"), F.max("_salts").alias("_salts"))
    earlier = W.partitionBy("_key").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    begun = per_range.withColumn("_last", F.last("_last", ignorenulls=True).over(earlier))
    copies = F.explode("_salts").alias("_salt")
    before = begun.where(F.col("_last").isNotNull()).select("_key", "_slot", "_last.*", F.lit(0).alias("_kind"), copies)
    within = known.join(ranges, ["_key", "_slot"]).select("_key", "_slot", "_at", "_value", F.lit(1).alias("_kind"), copies)

    line = before.unionByName(within).unionByName(asked, allowMissingColumns=True)
    order = W.partitionBy("_key", "_slot", "_salt").orderBy("_at", "_kind", "_value")
    found = F.last("_value", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    matched = line.withColumn("_found", found).where(F.col("_kind") == 2)
    names = [c for c in facts.columns if c not in columns]
    return matched.select(
        *[F.col("_fact")[c].alias(c) for c in names], *[F.when(valid, F.col("_found")[c]).alias(c) for c in columns]
    )


def reduce_dim(dim: DataFrame, facts: DataFrame, dim_key: str, key: str) -> DataFrame:
    """The rows of ``dim`` that a batch of facts refers to; the keys never leave the executors."""
    kind = facts.schema[key].dataType
    keys = facts.select(F.col(key).alias("_key")).distinct()
    return dim.join(keys, F.col(dim_key).try_cast(kind) == F.col("_key"), "left_semi")


def user_info(records: DataFrame, as_of: Column | None = None) -> DataFrame:
    """User dimension from (id, user_level, birthday, gender)."""
    age = age_years(F.col("birthday"), as_of)
    return records.select(
        "id",
        "user_level",
        age.alias("user_age"),
        age_group(age).alias("user_age_group"),
        gender_label(F.col("gender")).alias("user_gender"),
    )


def spu_info(spu: DataFrame, trademark: DataFrame, category3: DataFrame) -> DataFrame:
    """SPU dimension with the names of its trademark and category."""
    named = enrich(spu, trademark, "tm_id", "tm_id", {"tm_name": "tm_name"})
    return enrich(named, category3, "category3_id", "id", {"category3_name": "name"})


def sku_info(
    sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame, as_coded: bool = False
) -> DataFrame:
    """SKU dimension with the names of its SPU, trademark and category.

    ``as_coded`` looks the SPU name up by the trademark id, as the original jobs do.
    """
    spu_key = "tm_id" if as_coded else "spu_id"
    named = enrich(sku, spu, spu_key, "id", {"spu_name": "spu_name"}, keep_if_null=True)
    named = enrich(named, trademark, "tm_id", "tm_id", {"tm_name": "tm_name"})
    return enrich(named, category3, "category3_id", "id", {"category3_name": "name"})
