"""Monitoring job: new files of scored transactions -> model metrics per time window."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cardloom.session import add_store_arguments, job, store_conf
from cardloom.sources.snapshots import drop_old_versions, read_snapshot
from cardloom.streaming.jobs import merge_windows, metrics_of_sums, misdated_rows, run_batches, window_sums

ARRIVED = "_arrived"


def monitor(spark: SparkSession, scored: str, output: str, checkpoint: str, window: str = "1 day",
            files_per_batch: int | None = None) -> DataFrame:
    """Enter the files of scored rows that are new since the last run, and return the metrics of all windows.

    Only new files are read. The table at ``output`` keeps sums by window, so rows that come late correct
    their window. Rows dated after the time at which their file was written, or without a date, are in
    no window; they are kept in ``OUTPUT-misdated``, by batch. That time is the same in every run.
    """
    schema = spark.read.parquet(scored).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(scored).selectExpr("*", f"_metadata.file_modification_time AS {ARRIVED}")

    def enter(batch: DataFrame, number: int) -> None:
        misdated_rows(batch, ARRIVED).drop(ARRIVED).write.mode("overwrite").parquet(f"{output}-misdated/batch={number}")
        merge_windows(batch.where(f"tx_datetime <= {ARRIVED}"), output, checkpoint, number, window)
        drop_old_versions(spark, output)

    run_batches(rows, checkpoint, enter)
    return windows(spark, output, schema)


def windows(spark: SparkSession, output: str, scored_schema) -> DataFrame:
    """The metrics of all windows in the table that ``monitor`` keeps."""
    sums = window_sums(spark.createDataFrame([], scored_schema)).schema
    return metrics_of_sums(read_snapshot(spark, output, sums))


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--scored", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--checkpoint", required=True)
    args.add_argument("--window", default="1 day")
    add_store_arguments(args)
    opts = args.parse_args(argv)
    with job("monitor", store_conf(opts)) as spark:
        monitor(spark, opts.scored, opts.output, opts.checkpoint, opts.window)


if __name__ == "__main__":
    main()
