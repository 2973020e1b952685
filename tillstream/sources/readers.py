"""Sources."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import DAU_INFO, ORDER_WIDE

# The column that tells the order of messages.
ARRIVAL = "arrival"

# A file of messages: the columns that a message topic has.
MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def kafka_options(
    servers: str,
    topics: Sequence[str],
    group: str | None = None,
    offsets: Mapping[str, Mapping[int, int]] | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a topic source.

    A new query starts at the latest offsets, or at ``offsets`` (topic to partition to
    next offset) when another system has stored them. A query that has a checkpoint
    goes on from there and looks at neither.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "latest",
    }
    if group:
        options["kafka.group.id"] = group
    if offsets:
        options["startingOffsets"] = json.dumps(
            {t: {str(p): o for p, o in parts.items()} for t, parts in offsets.items()}
        )
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_stream(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str],
    path: str | None = None,
    schema: T.StructType | None = None,
    ordered: bool = False,
) -> DataFrame:
    """A stream of messages; binary keys and values come as text.

    ``ordered`` adds the column ``arrival``, by which later messages are greater:
    the offset in a topic, where the messages of one key share a partition; the
    time, name and row number of a file.
    """
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    if ordered and "offset" in df.columns:
        df = df.withColumn(ARRIVAL, F.struct("offset", "partition"))
    elif ordered:
        file = [F.col(f"_metadata.{c}").alias(c) for c in ("file_modification_time", "file_path", "row_index")]
        df = df.select("*", F.struct(*file).alias(ARRIVAL))
    binary = [f.name for f in df.schema if isinstance(f.dataType, T.BinaryType)]
    return df.withColumns({c: F.col(c).cast("string") for c in binary})


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """A stream of app log lines, one JSON text per row in ``value``."""
    return spark.readStream.text(path)


def read_dim(spark: SparkSession, path: str, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Some columns and rows of a dimension table; both reach the scan."""
    df = spark.read.parquet(path)
    return (df if where is None else df.where(where)).select(*columns)


def read_jdbc(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    """The result of a query that the database runs.

    For a large table give ``dbtable``-style partitioning in ``properties``
    (``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``): the
    query is then read as a subquery, split over that many tasks.
    """
    return spark.read.format("jdbc").options(**jdbc_read_options(url, query, properties)).load()


def jdbc_read_options(url: str, query: str, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    options = {"url": url, **(properties or {})}
    if "partitionColumn" in options:
        options["dbtable"] = f"({query}) t"
    else:
        options["query"] = query
    return options


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """The wide fact; a filter on ``dt`` prunes its folders."""
    return spark.read.schema(ORDER_WIDE).parquet(path).select(*ORDER_WIDE.names)


def read_dau(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """The daily index, or one day of it."""
    df = spark.read.schema(DAU_INFO).parquet(path).select(*DAU_INFO.names)
    return df if dt is None else df.where(F.col("dt") == dt)
