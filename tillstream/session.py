"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# State on disk, committed as a log of changes instead of a snapshot per batch.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Each store has 4 MB of disk set aside for its log else, however small it is.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # Both the stores and the log of changes; rows of state are mostly zeros.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "16",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # A join keeps one store per task instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Nothing here sets shuffle.partitions or memory: those belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    **SKEW_SETTINGS,
    **STATE_SETTINGS,
}


def build_session(name: str = "tillstream", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Let a session that was built elsewhere split hot join keys."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the folder the cluster shares.

    The shared folder is ``spark.checkpoint.dir``. Only a session in one process
    may go without it, as tests do; executors of their own need a shared folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tillstream-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Shuffle files go when the table command or count that wrote them has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def no_shuffles_left(spark: SparkSession):
    """Writes inside this block remove their shuffle files at their end, not when the driver collects its garbage."""
    before = spark.conf.get(TIDY)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Start queries inside this block with state on disk instead of on the JVM heap.

    A streaming query copies the session when it starts, so the caller's own
    settings can be put back at once.
    """
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
