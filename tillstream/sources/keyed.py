"""Tables with a primary key that micro-batches update."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators.dws import first_seen
from tillstream.sources.files import delete, finished_batches


def _newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def upsert_latest(current: DataFrame, updates: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """``current`` with ``updates`` written over it by key; the greatest ``version`` wins, an update before a tie."""
    both = current.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return first_seen(both, keys, [*_newest_first(version), F.col("_new").desc()]).drop("_new")


def keys_of(facts: DataFrame, column: str, table: KeyedTable) -> DataFrame:
    """The distinct keys by which a batch of facts refers to a table with one key column."""
    key = table.keys[0]
    return facts.select(F.col(column).cast(table.schema[key].dataType).alias(key)).distinct()


class KeyedTable:
    """A keyed table kept as its changes, one folder per micro-batch, plus a compacted state now and then.

    A batch writes only its own rows, so the cost of a batch does not grow with the
    table. ``read(before=n)`` shows the table as it was before batch ``n``, which
    keeps a replayed batch from seeing what it wrote itself. One job writes a
    table, and table and checkpoint belong together: batch numbers start again
    with a new checkpoint.

    ``tidy`` compacts when ``every`` changes have come together. The compacted rows
    lie in ``buckets`` folders by a hash of the key, and a read of some keys opens
    the folders of these keys only, so a batch reads the changes since the last
    compaction and its share of the state, however long the job runs. A table whose
    number of buckets was changed is read whole until the next compaction.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        every: int = 50,
    ):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.buckets, self.every = buckets, every

    def upsert(self, rows: DataFrame, batch_id: int, version: Sequence[str] | None) -> None:
        """Write one batch; of several rows with one key the greatest ``version`` stays: the last write wins.

        With an empty ``version`` the other columns decide. None is for rows whose keys are known to be unique,
        such as those of ``first_seen``: they are written as they are, without another shuffle by key.
        """
        if version is None:
            _write(rows.select(*self.schema.names), f"{self.path}/changes/batch_id={batch_id}")
            return
        # The other columns settle ties, so that a replay keeps the same row.
        order = [*_newest_first(version), *[F.col(c) for c in self.schema.names]]
        latest = first_seen(rows, self.keys, order).select(*self.schema.names)
        _write(latest, f"{self.path}/changes/batch_id={batch_id}")

    def read(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The latest row of each key, of all batches or of those below ``before``.

        ``only`` holds distinct keys: folders and rows of other keys are left out.
        """
        base, changes = self._batches(before)
        rows, single = self._rows("changes", changes), len(base) + len(changes) < 2
        if base:
            state = self._rows("compacted", base, ["_buckets", "_bucket"])
            if only is not None:
                state = state.where((F.col("_buckets") != self.buckets) | F.col("_bucket").isin(self._touched(only)))
            rows = state.drop("_buckets", "_bucket").unionByName(rows)
        if only is not None:
            rows = rows.join(only, self.keys, "left_semi")
        if single:
            # Each folder has a key once: no shuffle is needed.
            return rows.select(*self.schema.names)
        return first_seen(rows, self.keys, _newest_first(["batch_id"])).select(*self.schema.names)

    def written(self, batch_id: int) -> DataFrame:
        """What ``upsert`` has stored of a batch."""
        return self._rows("changes", [batch_id]).select(*self.schema.names)

    def compact(self, before: int, keep: Column | None = None) -> None:
        """Store the table as of batch ``before``, so that later reads need only newer changes.

        ``keep`` drops expired rows. A state that is there already stays as it is:
        others may be reading it.
        """
        if before - 1 in self._finished("compacted"):
            return
        rows = self.read(before)
        rows = rows if keep is None else rows.where(keep)
        rows = rows.withColumns({"_buckets": F.lit(self.buckets), "_bucket": self._bucket()})
        rows = rows.repartition(self.buckets, "_bucket")
        _write(rows, f"{self.path}/compacted/batch_id={before - 1}", ["_buckets", "_bucket"])

    def tidy(self, batch_id: int, keep: Callable[[], Column] | None = None) -> None:
        """Called by the job that writes the table, before it writes ``batch_id``: compact when it is time.

        What nobody needs any more is removed: batches below ``batch_id`` can't be
        replayed, and readers of the state before the last one have had the time of
        ``every`` batches to end.
        """
        _, changes = self._batches(batch_id)
        if len(changes) < self.every:
            return
        self.compact(batch_id, keep and keep())
        *old, oldest, _ = [-1, *self._finished("compacted")]
        delete(self.spark, [f"{self.path}/compacted/batch_id={n}" for n in old if n >= 0])
        covered = [n for n in self._finished("changes") if n <= oldest]
        delete(self.spark, [f"{self.path}/changes/batch_id={n}" for n in covered])

    def _bucket(self) -> Column:
        keys = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _touched(self, only: DataFrame) -> list[int]:
        """The buckets of some keys: at most ``buckets`` numbers."""
        return [r[0] for r in only.select(self._bucket()).distinct().collect()]

    def _finished(self, kind: str) -> list[int]:
        return finished_batches(self.spark, f"{self.path}/{kind}")

    def _batches(self, before: int | None) -> tuple[list[int], list[int]]:
        """The newest compacted state below ``before``, and the changes since."""

        def finished(kind):
            return [n for n in self._finished(kind) if before is None or n < before]

        # Changes first: a state that is compacted meanwhile has them too.
        changes, base = finished("changes"), finished("compacted")[-1:]
        return base, [n for n in changes if not base or n > base[0]]

    def _rows(self, kind: str, batches: list[int], folders: Sequence[str] = ()) -> DataFrame:
        """One scan over the folders of some batches; the folders' names give ``batch_id`` and ``folders``."""
        extra = [T.StructField("batch_id", T.LongType()), *[T.StructField(c, T.IntegerType()) for c in folders]]
        schema = T.StructType([*self.schema.fields, *extra])
        if not batches:
            return self.spark.createDataFrame([], schema)
        root = f"{self.path}/{kind}"
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*[f"{root}/batch_id={n}" for n in batches])


def _write(rows: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Replace a folder; its success file says that all of it is there."""
    marked = rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").option("compression", "zstd")
    marked.option("partitionOverwriteMode", "static").mode("overwrite").partitionBy(*by).parquet(path)
