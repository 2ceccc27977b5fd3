"""Tables that change by whole blocks of rows, with a switch that a failed write never reaches.

A table is a folder of three Parquet datasets. ``data`` holds the rows, partitioned by ``block`` and
by the ``version`` that wrote the block. ``blocks`` holds, for each version, the version in which
every block of the table stands. ``log`` has one row per version: which batch of which source it
entered. A change writes new versions of the blocks that it touches, then the list of blocks, then
its row of the log; only this last one, a single file, makes it visible. So a write that fails
half-way leaves the old table readable, its leftovers belong to no version and go with the old ones, and a batch
that comes again is known by the log and changes nothing. Nothing but lists of blocks and log rows,
which are far fewer than rows, comes to the driver.

A table has one writer at a time; readers need no care.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardloom.sources.tables import read_table, stage

LOG = "version LONG, source STRING, batch LONG"
BLOCKS = "block LONG, standing LONG, version LONG"
Combine = Callable[[DataFrame], DataFrame]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """``(version, source, batch)`` of every change; of a table not yet written, none."""
    return _read(spark, f"{path}/log", LOG)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an earlier one that has not been dropped."""
    version = last_version(spark, path) if version is None else version
    blocks = [] if version is None else _standing(spark, path, version).collect()
    return _rows(spark, path, schema, blocks)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its path: the newest version of a snapshot table, or plain Parquet."""
    if read_log(spark, path).isEmpty():
        return read_table(spark, path)
    data = spark.read.parquet(f"{path}/data").schema
    return read_snapshot(spark, path, T.StructType([field for field in data if field.name not in ("block", "version")]))


def merge_batch(rows: DataFrame, path: str, block: str, combine: Combine, source: str, batch: int) -> bool:
    """Enter a batch of rows; False if the log has it already.

    ``block`` is SQL for the number of a row's block. All rows that ``combine`` may put together must
    share it, and a block should be a small part of the table. ``combine`` gets the rows of the touched
    blocks, old and new ones together, and returns what is to stand there, in the same columns. A block
    that becomes empty leaves the table. An empty batch is entered in the log and changes no row.
    """
    spark, schema = rows.sparkSession, rows.schema
    log = read_log(spark, path)
    if not log.where(F.col("source").eqNullSafe(source) & F.expr(f"batch >= {batch}")).isEmpty():
        return False
    last = last_version(spark, path)
    new = stage(rows, "batch")
    touched = stage(new.selectExpr(f"CAST({block} AS BIGINT) AS block").distinct(), "touched")
    standing = _standing(spark, path, last)
    old = _rows(spark, path, schema, standing.join(touched, "block", "left_semi").collect())
    merged = combine(old.unionByName(new)).select(*rows.columns)
    _commit(merged, path, block, standing.join(touched, "block", "left_anti"), source, batch, last)
    return True


def replace_table(rows: DataFrame, path: str, block: str = "0", source: str = "replace") -> None:
    """Put other rows in place of all rows of the table, which stays readable until they are written."""
    spark, last = rows.sparkSession, last_version(rows.sparkSession, path)
    _commit(rows, path, block, spark.createDataFrame([], "block LONG, standing LONG"), source, last or 0, last)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what only versions before the last ``keep`` use; returns the number of folders deleted."""
    versions = [row.version for row in read_log(spark, path).select("version").distinct().orderBy(F.desc("version")).limit(keep).collect()]
    if len(versions) < keep:
        return 0
    needed = {(row.block, row.standing) for version in versions for row in _standing(spark, path, version).collect()}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = 0
    for block in files.listStatus(root) if files.exists(root) else []:
        for version in files.listStatus(block.getPath()) if block.isDirectory() else []:
            names = [part.getPath().getName().partition("=") for part in (block, version)]
            if names[1][0] != "version" or int(names[1][2]) > versions[-1]:
                continue
            if (int(names[0][2]), int(names[1][2])) not in needed:
                files.delete(version.getPath(), True)
                dropped += 1
    return dropped


def last_version(spark: SparkSession, path: str) -> int | None:
    return read_log(spark, path).agg(F.max("version")).first()[0]


def _commit(rows: DataFrame, path: str, block: str, others: DataFrame, source: str, batch: int, last: int | None) -> None:
    # A number of its own for each try, so that what a failed one leaves behind is never taken for this one's.
    spark, version = rows.sparkSession, max((last or 0) + 1, time.time_ns() // 1000)
    placed = rows.selectExpr("*", f"CAST({block} AS BIGINT) AS block", f"{version}L AS version")
    placed.hint("rebalance", "block").write.mode("append").partitionBy("block", "version").parquet(f"{path}/data")
    blocks = spark.createDataFrame([(number, version) for number in _blocks_written(spark, path, version)],
                                   "block LONG, standing LONG")
    listed = others.select("block", "standing").union(blocks).selectExpr("*", f"{version}L AS version")
    listed.coalesce(1).write.mode("append").partitionBy("version").parquet(f"{path}/blocks")
    spark.createDataFrame([(version, source, batch)], LOG).coalesce(1).write.mode("append").parquet(f"{path}/log")


def _blocks_written(spark: SparkSession, path: str, version: int) -> list[int]:
    """Blocks that hold rows of a version, by the names of their folders."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/block=*/version={version}")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [int(folder.getPath().getParent().getName().partition("=")[2]) for folder in found or []]


def _standing(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """``(block, standing)`` of one version of the table."""
    if version is None:
        return spark.createDataFrame([], "block LONG, standing LONG")
    return _read(spark, f"{path}/blocks", BLOCKS).where(f"version = {version}").select("block", "standing")


def _rows(spark: SparkSession, path: str, schema: T.StructType, blocks: list) -> DataFrame:
    if not blocks:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/block={row.block}/version={row.standing}" for row in blocks]
    return spark.read.schema(schema).parquet(*folders)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
