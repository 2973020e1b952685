"""Folders of finished micro-batches, in whatever file system they lie."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def finished_batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the ``batch_id=N`` folders whose write was committed, in one listing."""
    marks = _path(spark, f"{folder}/batch_id=*/_SUCCESS")
    found = _system(spark, marks).globStatus(marks) or []
    return sorted(int(s.getPath().getParent().getName().removeprefix("batch_id=")) for s in found)


def exists(spark: SparkSession, name: str) -> bool:
    path = _path(spark, name)
    return _system(spark, path).exists(path)


def delete(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        path = _path(spark, name)
        _system(spark, path).delete(path, True)


def move(spark: SparkSession, name: str, to: str) -> None:
    """Rename a folder: readers see all of it or nothing where the file system renames at once."""
    source, target = _path(spark, name), _path(spark, to)
    files = _system(spark, source)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{name} can't be renamed to {to}")
