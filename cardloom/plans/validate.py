"""Validation job: baseline against tuned candidate, decided by a bootstrap t-test."""

from __future__ import annotations

import argparse
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.operators.comparison import (
    MODEL, bootstrap_counts_by_cell, compare_models, promotion_gate, sample_scores, score_intervals,
)
from cardloom.operators.evaluation import (
    MAX_MONTHLY_LOSS, classification_metrics, confusion_counts, error_rates, hard_areas, metrics_long, monthly_missed_loss,
)
from cardloom.operators.modelling import fit_scorer, param_rows, save_model, score_with_all, summary_rows, tune
from cardloom.plans.prepare import open_prepared
from cardloom.plans.train import WEIGHT, TrainOptions, known_model_options, prepare
from cardloom.schema import AMOUNT, EVENT_TIME, KEY, LABEL
from cardloom.session import add_store_arguments, job, store_conf
from cardloom.sources.snapshots import open_table
from cardloom.sources.tables import read_table, stage, write_run, write_table

BASELINE, CANDIDATE = "baseline", "candidate"


@dataclass(frozen=True)
class Validation:
    baseline: PipelineModel
    candidate: PipelineModel
    metrics: DataFrame
    scores: DataFrame
    decision: DataFrame
    goals: DataFrame
    losses: DataFrame


def validate(cleaned: DataFrame, options: TrainOptions = TrainOptions(), parallelism: int = 2,
             strict_gate: bool = True, max_loss: float = MAX_MONTHLY_LOSS) -> Validation:
    """Split the cleaned rows, fit both models on the training rows and compare them on the test rows."""
    train, test = prepare(cleaned, options)
    return validate_prepared(train, test, options, parallelism, strict_gate, max_loss)


def validate_prepared(train: DataFrame, test: DataFrame, options: TrainOptions = TrainOptions(), parallelism: int = 2,
                      strict_gate: bool = True, max_loss: float = MAX_MONTHLY_LOSS) -> Validation:
    """The same with rows that were prepared before.

    ``metrics`` has the baseline's training summary too. ``goals`` holds the error rates of each model
    against their limits and ``losses`` the fraud it missed by month against ``max_loss``; both are of
    the test rows, so a loss is that of their share of the transactions.
    """
    weight = WEIGHT if WEIGHT in train.columns else None
    baseline = fit_scorer(train, weight, options.with_scenario)
    candidate = tune(train, weight, options.with_scenario, parallelism=parallelism).model
    scored = stage(score_with_all(test, {BASELINE: baseline, CANDIDATE: candidate}, [KEY, LABEL, AMOUNT, EVENT_TIME]), "predictions")
    counts = confusion_counts(scored, by=[MODEL], unscored=True)
    metrics = metrics_long(hard_areas(classification_metrics(counts)), MODEL).unionByName(summary_rows(baseline, BASELINE))
    scores = sample_scores(bootstrap_counts_by_cell(scored))
    gate = promotion_gate(compare_models(scores, BASELINE, CANDIDATE))
    accepted = F.col("promote" if strict_gate else "differs")
    return Validation(baseline, candidate, metrics, scores, gate.withColumn("is_valid", accepted),
                      error_rates(counts), monthly_missed_loss(scored, by=[MODEL], limit=max_loss))


def run(spark: SparkSession, cleaned_path: str | None, output: str, options: TrainOptions = TrainOptions(),
        strict_gate: bool = True, run_id: str | None = None, parallelism: int = 2,
        max_loss: float = MAX_MONTHLY_LOSS, tables: str | None = None) -> bool:
    """Run the validation, write its tables below ``output`` and the accepted model as ``best_model``.

    The rows come from a cleaned table, or already split from the prepared ``tables`` of that name.

    Metrics and parameters go to run tables: each row has the run's id and time, and a run that is
    repeated under its id replaces its own rows and no others.
    """
    settings = options, parallelism, strict_gate, max_loss
    if tables:
        result = validate_prepared(*open_prepared(spark, tables), *settings)
    else:
        result = validate(open_table(spark, cleaned_path), *settings)
    run_id = run_id or uuid.uuid4().hex
    decided = result.decision.selectExpr(f"'{CANDIDATE}' AS run", "'is_valid' AS metric", "CAST(is_valid AS DOUBLE) AS value")
    write_run(result.metrics.unionByName(decided), f"{output}/metrics", run_id)
    write_run(param_rows(result.baseline, BASELINE).unionByName(param_rows(result.candidate, CANDIDATE)), f"{output}/params", run_id)
    write_table(score_intervals(result.scores), f"{output}/intervals")
    write_table(result.scores, f"{output}/scores")
    write_table(result.decision, f"{output}/decision")
    write_run(result.goals, f"{output}/goals", run_id)
    write_run(result.losses, f"{output}/losses", run_id)
    save_model(result.baseline, f"{output}/baseline_model")
    save_model(result.candidate, f"{output}/candidate_model")
    accepted = bool(read_table(spark, f"{output}/decision").first()["is_valid"])
    if accepted:
        save_model(result.candidate, f"{output}/best_model")
    return accepted


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    rows = args.add_mutually_exclusive_group(required=True)
    rows.add_argument("--cleaned")
    rows.add_argument("--tables", metavar="NAME", help="prepared tables NAME_train and NAME_test")
    args.add_argument("--output", required=True)
    args.add_argument("--fraction", type=float, default=1.0)
    args.add_argument("--run-id", help="the same id again replaces the rows of that run")
    args.add_argument("--known-order", action="store_true", help="balance before the split, scenario as a feature")
    args.add_argument("--max-loss", type=float, default=MAX_MONTHLY_LOSS, help="limit of the fraud missed in a month")
    args.add_argument("--parallelism", type=int, default=2, help="candidates fitted at a time")
    args.add_argument("--any-difference", action="store_true", help="accept any significant difference")
    add_store_arguments(args)
    opts = args.parse_args(argv)
    with job("validate", store_conf(opts)) as spark:
        options = known_model_options(opts.fraction) if opts.known_order else TrainOptions(fraction=opts.fraction)
        accepted = run(spark, opts.cleaned, opts.output, options, not opts.any_difference, opts.run_id, opts.parallelism,
                       opts.max_loss, opts.tables)
        print("candidate accepted" if accepted else "candidate rejected")


if __name__ == "__main__":
    main()
