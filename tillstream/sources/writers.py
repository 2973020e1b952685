"""Sinks. What a micro-batch writes goes to a folder of its own, so a replay overwrites itself."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.session import no_shuffles_left, rocksdb_state
from tillstream.sources.files import exists, move

Send = Callable[[DataFrame, int], None]
log = logging.getLogger(__name__)

ADAPTIVE = "spark.sql.adaptive.enabled"
# Files that a task keeps open at once; up to that many topics are written without sorting the messages by topic.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
TOPICS = 32

# Files of messages: row groups of 2 MB (compressed), so that all cores share the parsing of a batch of few files.
MESSAGE_FILES = {"parquet.block.size": str(2 << 20), "compression": "zstd"}

# Settings of the bulk insert of wide rows. How many tasks insert is the caller's choice.
JDBC_WRITE = {"batchsize": "100", "isolationLevel": "NONE"}


def run_of(df: DataFrame) -> str:
    """The id of the streaming query that a micro-batch belongs to, which its checkpoint keeps; else ``none``.

    A query that starts on a new checkpoint counts its batches from 0 again. Folders
    named by the query and the batch keep what another query wrote before.
    """
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def _batch_folder(df: DataFrame, batch_id: int) -> str:
    return f"run={run_of(df)}/batch_id={batch_id}"


def append_exactly_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Add the rows of one micro-batch.

    The rows and the fact that the batch is done are one thing: the folder
    ``run=Q/batch_id=N``. When a batch is run again its folder is replaced, so each
    row is stored once. An empty batch adds no row. (It is not skipped here: asking a
    stateful batch whether it is empty would run its state twice.)
    """
    df.write.option("compression", "zstd").mode("overwrite").parquet(f"{path}/{_batch_folder(df, batch_id)}")


def append_daily(df: DataFrame, path: str, batch_id: int) -> None:
    """Add rows to the folder of their own day, ``dt=D/run=Q/batch_id=N``, so that a report of a day lists one folder.

    Rows are brought together by day, so that a day is not cut into one small file
    per task; adaptive execution splits a day that is too large for one task. A
    batch that is run again has the same days, and replaces its own folder in each.
    """
    rows = df.withColumns({"run": F.lit(run_of(df)), "batch_id": F.lit(batch_id)}).hint("rebalance", "dt")
    writer = rows.write.options(partitionOverwriteMode="dynamic", compression="zstd").mode("overwrite")
    writer.partitionBy("dt", "run", "batch_id").parquet(path)


def send_messages(messages: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of messages to a folder that a file stream can read, by topic where there is one.

    A stream that follows the folder takes every new file as new messages. So a
    batch shows up whole, by a rename, and one that has been sent is not sent again
    when it is run again after a failure. A job on a new checkpoint is another query
    with folders of its own: none of its batches is taken for one of the old job's.
    """
    spark, name = messages.sparkSession, _batch_folder(messages, batch_id)
    folder, draft = f"{path}/{name}", f"{path}/_drafts/{name}"
    if exists(spark, folder):
        return
    by = ["topic"] if "topic" in messages.columns else []
    writer = messages.write.options(**MESSAGE_FILES).option("partitionOverwriteMode", "static").mode("overwrite")
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(TOPICS))
    try:
        writer.partitionBy(*by).parquet(draft)
    finally:
        spark.conf.set(OPEN_FILES, before)
    move(spark, draft, folder)


def sent_to(path: str, topic: str | None = None) -> str:
    """What a stream that follows ``folder_sink(path)`` reads: all messages, or those of one topic."""
    return f"{path}/run=*/batch_id=*" + (f"/topic={topic}" if topic else "")


def folder_sink(path: str) -> Send:
    """Messages of a job go to a folder."""
    return lambda messages, batch_id: send_messages(messages, path, batch_id)


def topic_sink(servers: str, topic: str | None = None) -> Send:
    """Messages of a job go to a broker, at least once: a batch that is run again sends them again.

    Every table that reads them keeps the last write of a key, so only statistics
    need to know; ``folder_sink`` sends each message once.
    """
    return lambda messages, batch_id: send_to_kafka(messages, servers, topic)


def send_to_kafka(messages: DataFrame, servers: str, topic: str | None = None) -> None:
    """Send one batch to a broker. Without ``topic`` each row's own ``topic`` column routes it."""
    writer = messages.write.format("kafka").options(**kafka_sink_options(servers, topic))
    writer.save()


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "kafka.enable.idempotence": "true", "kafka.acks": "all"}
    if topic:
        options["topic"] = topic
    return options


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", properties: Mapping[str, str] | None = None
) -> None:
    """Append rows to a database table."""
    options = {**JDBC_WRITE, "url": url, "dbtable": table, **(properties or {})}
    df.write.format("jdbc").options(**options).mode(mode).save()


def _drop_shuffles(batch: DataFrame) -> None:
    """Remove the shuffle files of a micro-batch that is done; Spark itself waits until the driver collects its plan."""
    rdd = batch._jdf.queryExecution().toRdd()
    # This RDD has not run: it looks for its parents only when it is asked for them.
    rdd.dependencies()
    rdd.cleanShuffleDependencies(False)


def _adaptive(sink: Send) -> Send:
    """Run a micro-batch function with adaptive execution, which Spark turns off for streams, and drop its shuffle files.

    The stateful part of the batch is planned before the function is called; the
    joins and writes inside the function are ordinary ones, and get their hot keys
    split and their small tables broadcast again. Shuffle files go with their batch,
    so that those of all batches never lie there at once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(ADAPTIVE)
        conf.set(ADAPTIVE, "true")
        try:
            with no_shuffles_left(batch.sparkSession):
                sink(batch, batch_id)
        finally:
            conf.set(ADAPTIVE, before)
        _drop_shuffles(batch)

    return run


def write_stream(
    df: DataFrame,
    sink: str | Callable[[DataFrame, int], None],
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query. ``sink`` is a format, or a function that gets each micro-batch and its number.

    ``checkpoint`` holds the offsets and the state: started again with the same
    folder, the query goes on where it stopped. ``every`` is the batch interval;
    without it the query takes what is there and ends.
    """
    writer = df.writeStream.option("checkpointLocation", checkpoint).options(**(options or {}))
    writer = writer.foreachBatch(_adaptive(sink)) if callable(sink) else writer.format(sink)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    with rocksdb_state(df.sparkSession):
        return writer.start()


def finish(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Wait for a query that ends by itself, as long as it takes; with ``seconds``, stop it and fail after them.

    The time and the rows of state of its last batches go to the log.
    """
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not end in {seconds} s")
    for batch in query.recentProgress:
        state = sum(operator["numRowsTotal"] for operator in batch["stateOperators"])
        log.info("batch %s: %s ms, %s rows in, %s rows of state", batch["batchId"], batch["batchDuration"], batch["numInputRows"], state)
    return query
