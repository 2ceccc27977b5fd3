"""Preparation job: cleaned table -> named train and test tables, bucketed and sorted by transaction.

Training and validation that start from them read the same rows, however often they run, and
aggregates by transaction and joins on it need no shuffle.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cardloom.plans.train import TrainOptions, known_model_options, prepare
from cardloom.schema import KEY
from cardloom.session import add_store_arguments, job, store_conf
from cardloom.sources.snapshots import open_table
from cardloom.sources.tables import write_bucketed

PARTS = ("train", "test")


def prepare_tables(cleaned: DataFrame, name: str, options: TrainOptions = TrainOptions(), buckets: int = 200,
                   path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write ``NAME_train`` and ``NAME_test`` and return them; ``path`` is a folder for their files, else the warehouse.

    Choose ``buckets`` so that one holds some hundred megabytes, and alike for all tables that are to be joined.
    """
    parts = zip(PARTS, prepare(cleaned, options))
    train, test = (write_bucketed(rows, f"{name}_{part}", KEY, buckets, path and f"{path}/{part}") for part, rows in parts)
    return train, test


def open_prepared(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame]:
    train, test = (spark.table(f"{name}_{part}") for part in PARTS)
    return train, test


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--cleaned", required=True)
    args.add_argument("--tables", required=True, metavar="NAME", help="write NAME_train and NAME_test, NAME as in DATABASE.NAME")
    args.add_argument("--location", help="folder of the files, else the warehouse")
    args.add_argument("--buckets", type=int, default=200)
    args.add_argument("--fraction", type=float, default=1.0)
    args.add_argument("--known-order", action="store_true", help="balance before the split, scenario as a feature")
    add_store_arguments(args)
    opts = args.parse_args(argv)
    with job("prepare", store_conf(opts)) as spark:
        options = known_model_options(opts.fraction) if opts.known_order else TrainOptions(fraction=opts.fraction)
        prepare_tables(open_table(spark, opts.cleaned), opts.tables, options, opts.buckets, opts.location)


if __name__ == "__main__":
    main()
