"""Training job: cleaned table -> sample -> split -> balance -> features -> classifier."""

from __future__ import annotations

import argparse
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cardloom.operators.evaluation import classification_metrics, confusion_counts, metrics_long
from cardloom.operators.features import fit_features
from cardloom.operators.modelling import classifier, fit_scorer, param_rows, save_model, score_rows, summary_rows
from cardloom.operators.sampling import class_weights, oversample_minority, sample_rows, split_rows
from cardloom.schema import KEY, LABEL
from cardloom.session import add_store_arguments, job, store_conf
from cardloom.sources.snapshots import open_table
from cardloom.sources.tables import stage, write_run

WEIGHT = "class_weight"

# Share of the cleaned rows used for training, and the train/test weights.
SAMPLE_FRACTION = 0.01 / (0.01 + 0.95)
SPLIT = (0.8, 0.2)


@dataclass(frozen=True)
class TrainOptions:
    """How the training rows are prepared.

    The defaults keep the test rows untouched: split first, balance the training part by a
    weight, fit the features on it. ``oversample`` repeats fraud rows instead.
    ``balance_before_split`` repeats the known order of steps, where copies of one fraud row and
    the feature ranges reach both parts; with ``with_scenario`` it gives the known model.
    """

    fraction: float = 1.0
    oversample: bool = False
    balance_before_split: bool = False
    with_scenario: bool = False
    method: str = "xxhash64"


def known_model_options(fraction: float = SAMPLE_FRACTION) -> TrainOptions:
    return TrainOptions(fraction=fraction, oversample=True, balance_before_split=True, with_scenario=True)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    train: DataFrame
    test: DataFrame


def prepare(cleaned: DataFrame, options: TrainOptions) -> tuple[DataFrame, DataFrame]:
    """Training and test rows.

    A fit passes over its rows several times. What those passes should not repeat is staged:
    the sampling scan, and the balance with its count of the classes.
    """
    rows = cleaned
    if options.fraction < 1:
        rows = stage(sample_rows(cleaned, options.fraction, method=options.method), "sample")
    if options.balance_before_split:
        # The copy number is part of the key, so that copies are split one by one.
        copies = stage(oversample_minority(rows, copy_column="_copy"), "balanced")
        train, test = split_rows(copies, SPLIT, key=(KEY, "_copy"), method=options.method)
        return train.drop("_copy"), test.drop("_copy")
    train, test = split_rows(rows, SPLIT, method=options.method)
    balanced = oversample_minority(train) if options.oversample else class_weights(train, weight=WEIGHT)
    return stage(balanced, "balanced"), test


def train_model(cleaned: DataFrame, options: TrainOptions = TrainOptions()) -> Trained:
    train, test = prepare(cleaned, options)
    if options.balance_before_split:
        features = fit_features(train.unionByName(test), options.with_scenario)
        fitted = classifier().fit(features.transform(train))
        model = PipelineModel([*features.stages, fitted])
    else:
        model = fit_scorer(train, None if options.oversample else WEIGHT, options.with_scenario)
    return Trained(model, train, test)


def evaluate(trained: Trained, run: str) -> DataFrame:
    """Training summary and hold-out metrics as ``(run, metric, value)``; test rows that cannot be scored are counted."""
    counts = confusion_counts(score_rows(trained.test, trained.model, keep=[LABEL]), unscored=True)
    held_out = classification_metrics(counts).selectExpr(f"'{run}' AS run", "*")
    return summary_rows(trained.model, run).unionByName(metrics_long(held_out, "run"))


def run(spark: SparkSession, cleaned_path: str, model_path: str, metrics_path: str, params_path: str | None = None,
        name: str = "baseline", options: TrainOptions = TrainOptions(), run_id: str | None = None) -> Trained:
    """Train, and write the metrics and parameters of this run and the model.

    A run that is repeated under its id replaces its own rows and no others.
    """
    trained = train_model(open_table(spark, cleaned_path), options)
    run_id = run_id or uuid.uuid4().hex
    write_run(evaluate(trained, name), metrics_path, run_id)
    if params_path:
        write_run(param_rows(trained.model, name), params_path, run_id)
    save_model(trained.model, model_path)
    return trained


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--cleaned", required=True)
    args.add_argument("--model", required=True)
    args.add_argument("--metrics", required=True)
    args.add_argument("--params")
    args.add_argument("--run", default="baseline")
    args.add_argument("--run-id", help="the same id again replaces the rows of that run")
    args.add_argument("--fraction", type=float, default=1.0)
    args.add_argument("--known-model", action="store_true", help="repeat the known order of steps")
    add_store_arguments(args)
    opts = args.parse_args(argv)
    with job("train", store_conf(opts)) as spark:
        options = known_model_options() if opts.known_model else TrainOptions(fraction=opts.fraction)
        run(spark, opts.cleaned, opts.model, opts.metrics, opts.params, opts.run, options, opts.run_id)


if __name__ == "__main__":
    main()
