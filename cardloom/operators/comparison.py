"""Bootstrap a metric for several models at once and decide between two of them."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.functions.hashing import bucket_of, drawn_once, poisson_draw, unit_uniform
from cardloom.functions.stats import t_critical, t_critical_large, t_two_sided_p
from cardloom.operators.evaluation import CELLS, confusion_counts, hard_areas, swap_roles
from cardloom.schema import KEY, LABEL

# Size of the bootstrap and levels of the tests.
REPLICATES = 100
FRACTION = 0.01
CONFIDENCE = 0.95
ALPHA = 0.01

MODEL = "model"


def bootstrap_counts(predictions: DataFrame, replicates: int = REPLICATES, fraction: float = FRACTION,
                     key: str = KEY, label: str = LABEL, method: str = "xxhash64") -> DataFrame:
    """Confusion counts of every bootstrap sample: ``(model, replicate, tp, fp, fn, tn)``.

    A sample with replacement takes each row Poisson(fraction) times. Over all samples a row
    is taken Poisson(replicates * fraction) times, and each of these goes to any sample with
    the same chance. So one pass draws that total, expands it, and counts; the shuffle
    carries one partial count per task, model and sample.
    """
    uniform = unit_uniform("draws", MODEL, key, method=method)
    drawn = (
        predictions.selectExpr(MODEL, key, label, "prediction", f"{drawn_once(uniform)} AS u")
        .selectExpr("*", f"{poisson_draw('u', replicates * fraction)} AS drawn")
        .filter("drawn > 0")
    )
    copies = drawn.selectExpr(MODEL, key, label, "prediction", "explode(sequence(1, drawn)) AS copy")
    replicate = bucket_of(replicates, "replicate", MODEL, key, "copy", method=method)
    placed = copies.selectExpr(MODEL, label, "prediction", f"{replicate} AS replicate")
    return confusion_counts(placed, by=[MODEL, "replicate"], label=label)


def bootstrap_counts_by_cell(predictions: DataFrame, replicates: int = REPLICATES, fraction: float = FRACTION,
                             label: str = LABEL, seed: int = 7) -> DataFrame:
    """The same counts, drawn from the confusion cells instead of the rows.

    Hard predictions put each row in one of four cells, and independent Poisson draws of the
    rows of a cell add up to one Poisson draw of the cell. After a single aggregate only
    ``models * 4 * replicates`` draws remain, whatever the size of the table.
    """
    cells = ", ".join(f"named_struct('cell', '{c}', 'rows', {c})" for c in CELLS)
    counts = confusion_counts(predictions, by=[MODEL], label=label).selectExpr(MODEL, f"inline(array({cells}))")
    samples = counts.selectExpr("*", f"explode(sequence(0, {replicates - 1})) AS replicate")

    @F.pandas_udf("bigint")
    def draw(model: pd.Series, cell: pd.Series, replicate: pd.Series, rows: pd.Series) -> pd.Series:
        return pd.Series([
            np.random.default_rng([seed, zlib.crc32(f"{m}/{c}".encode()), r]).poisson(fraction * n)
            for m, c, r, n in zip(model, cell, replicate, rows)
        ])

    drawn = samples.withColumn("drawn", draw(MODEL, "cell", "replicate", "rows"))
    return drawn.groupBy(MODEL, "replicate").agg(*[F.expr(f"sum(if(cell = '{c}', drawn, 0L)) AS {c}") for c in CELLS])


def sample_scores(counts: DataFrame, swapped: bool = False) -> DataFrame:
    """Area under the precision-recall curve of each sample: ``(model, replicate, score)``."""
    areas = hard_areas(swap_roles(counts) if swapped else counts)
    return areas.selectExpr(MODEL, "replicate", "area_under_pr AS score")


def score_intervals(scores: DataFrame, confidence: float = CONFIDENCE, replicates: int = REPLICATES) -> DataFrame:
    """Confidence interval of the mean score of each model, from Student's t.

    Up to ``replicates`` samples the limits are exact, beyond that an expansion in the number of samples.
    """
    limits = ", ".join(f"{t_critical(confidence, freedom)!r}D" for freedom in range(1, replicates))
    stats = scores.groupBy(MODEL).agg(
        F.expr("count(score) AS samples"), F.expr("avg(score) AS mean"), F.expr("stddev_pop(score) AS spread")
    )
    limit = (
        f"CASE WHEN samples <= {replicates} THEN get(array({limits}), CAST(samples AS INT) - 2) "
        f"ELSE {t_critical_large(confidence, 'samples - 1')} END"
    )
    half = f"{limit} * spread / sqrt(CAST(samples AS DOUBLE))"
    return stats.selectExpr(MODEL, "samples", "mean", f"{half} AS half").selectExpr(
        MODEL, "samples", "mean", "mean - half AS low", "mean + half AS high"
    )


def compare_models(scores: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """Two-sample t-test with pooled variance, one row: means, t, degrees of freedom, p.

    Without any spread, t is infinite if the means differ and NULL if they do not.
    """
    sides = []
    for side, name in (("baseline", baseline), ("candidate", candidate)):
        of = f"CASE WHEN {MODEL} = '{name}' THEN score END"
        sides += [f"count({of}) AS n_{side}", f"avg({of}) AS mean_{side}", f"var_samp({of}) AS var_{side}"]
    pooled = (
        "try_divide((n_baseline - 1) * var_baseline + (n_candidate - 1) * var_candidate, "
        "CAST(n_baseline + n_candidate - 2 AS DOUBLE))"
    )
    error = f"sqrt({pooled} * (try_divide(1D, n_baseline) + try_divide(1D, n_candidate)))"
    tested = scores.agg(*map(F.expr, sides)).selectExpr(
        "mean_baseline", "mean_candidate", "mean_baseline - mean_candidate AS gap", f"{error} AS error",
        "CAST(n_baseline + n_candidate - 2 AS INT) AS freedom",
    ).selectExpr(
        "mean_baseline", "mean_candidate",
        "if(error = 0 AND gap <> 0, sign(gap) * double('Infinity'), try_divide(gap, error)) AS t",
        "freedom",
    )
    return tested.selectExpr("*", f"{t_two_sided_p('t', 'freedom')} AS p_value")


def promotion_gate(test: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Whether the candidate replaces the baseline.

    ``differs`` is the bare test, which a significantly worse candidate passes too;
    ``promote`` also asks for a better mean.
    """
    differs = f"coalesce(p_value < {alpha!r}D, false)"
    return test.selectExpr(
        "*", f"{differs} AS differs", f"{differs} AND coalesce(mean_candidate > mean_baseline, false) AS promote"
    )


def score_histogram(scores: DataFrame, bins: int = 20) -> DataFrame:
    """Samples per model and equal-width score bin over [0, 1]: ``(model, bin, samples)``."""
    binned = scores.selectExpr(MODEL, f"least(CAST(floor(score * {bins}) AS INT), {bins - 1}) AS bin")
    return binned.groupBy(MODEL, "bin").agg(F.expr("count(*) AS samples"))
