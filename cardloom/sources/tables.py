"""Parquet tables, staged intermediates and cached datasets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardloom.session import scratch_path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    """Write Parquet. With ``partition_by``, rows are first rebalanced on that column.

    Without the rebalance every task would open a file in every partition folder; the hint
    lets adaptive execution split a partition value that holds most of the rows and merge
    the small ones.
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by).parquet(path)


def write_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Enter the rows of one run in a run table, with its id and the time.

    The table has a folder for each run. Only the folder of ``run_id`` is replaced, so a run that is
    started again leaves one set of rows, and runs at the same time do not touch each other's.
    """
    stamped = rows.select("*", F.current_timestamp().alias("run_time"), F.lit(run_id).alias("run_id"))
    stamped.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """A run table; the ids are text, whatever they look like."""
    names = spark.read.parquet(path).schema
    fields = [T.StructField("run_id", T.StringType()) if field.name == "run_id" else field for field in names]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write a named table whose files are bucketed and sorted by ``key``, and return it.

    Rows are dealt by the key before the write, so a bucket is one file and one task. Aggregates by the
    key and joins of tables with the same number of buckets then need no shuffle. Made for tables with
    few rows a key, as after de-duplication: a bucket is never split. ``path`` is where the files go, else
    the warehouse; a table of that name is replaced.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and return it as a table scan.

    Used where several jobs read one result. Unlike a cached block, the files survive a
    lost executor, and later readers still prune columns and push filters.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cached(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep datasets in memory, spilling to disk, for the length of a ``with`` block."""
    kept = tuple(frame.persist(StorageLevel.MEMORY_AND_DISK) for frame in frames)
    try:
        yield kept
    finally:
        for frame in kept:
            frame.unpersist()
