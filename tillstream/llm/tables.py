"""Reading the input tables and keeping intermediate tables in the folder the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.session import work_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage in files that outlive any executor, so what follows
    neither repeats the work nor depends on how the rows were dealt out.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def joined_small(df: DataFrame, small: DataFrame, on: str, most: int = 100_000) -> DataFrame:
    """Inner join with a written table of one narrow row per ``on``: by broadcast up to ``most`` rows, else by shuffle.

    Without a broadcast a key with a third of all rows would be read by one task.
    """
    return df.join(F.broadcast(small) if small.count() <= most else small, on)
