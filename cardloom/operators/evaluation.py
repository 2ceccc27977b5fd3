"""Quality of predictions: confusion counts, rates, curve areas, business limits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from cardloom.functions.stats import hard_area_under_pr, hard_area_under_roc, ratio
from cardloom.schema import AMOUNT, EVENT_TIME, LABEL
from cardloom.sources.tables import stage

CELLS = ("tp", "fp", "fn", "tn")
UNSCORED = ("unscored_fraud", "unscored_normal")

# The limits a first release has to meet.
MAX_FALSE_POSITIVE_RATE = 0.05
MAX_FALSE_NEGATIVE_RATE = 0.02
MAX_MONTHLY_LOSS = 500_000.0


def _add(df: DataFrame, **columns: str) -> DataFrame:
    """Add or replace columns given as SQL text."""
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def confusion_counts(df: DataFrame, by: Sequence[str] = (), label: str = LABEL,
                     prediction: str = "prediction", unscored: bool = False) -> DataFrame:
    """``(by..., tp, fp, fn, tn)`` in one pass.

    With ``unscored`` the rows that have a label but no prediction are counted as well, by class.
    """
    missing = [f"count_if({label} = {y} AND {prediction} IS NULL) AS {name}" for y, name in zip((1, 0), UNSCORED)]
    actual_and_predicted = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    return df.groupBy(*by).agg(*[
        F.expr(f"count_if({label} = {y} AND {prediction} = {p}) AS {cell}")
        for cell, (y, p) in actual_and_predicted.items()
    ], *[F.expr(text) for text in missing if unscored])


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1; NULL where a rate has no base.

    Where unscored rows were counted, also the share of rows that were scored and the recall among
    all fraud, scored or not.
    """
    rated = _add(
        counts,
        accuracy=ratio("tp + tn", "tp + fp + fn + tn"),
        precision=ratio("tp", "tp + fp"),
        recall=ratio("tp", "tp + fn"),
        f1=ratio("2 * tp", "2 * tp + fp + fn"),
    )
    if not set(UNSCORED) <= set(counts.columns):
        return rated
    return _add(rated, scored_share=ratio("tp + fp + fn + tn", f"tp + fp + fn + tn + {' + '.join(UNSCORED)}"),
                recall_of_all=ratio("tp", "tp + fn + unscored_fraud"))


def hard_areas(counts: DataFrame) -> DataFrame:
    """Add the areas under ROC and PR of the 0/1 predictions."""
    return _add(counts, area_under_roc=hard_area_under_roc(), area_under_pr=hard_area_under_pr())


def swap_roles(counts: DataFrame) -> DataFrame:
    """Counts as seen when the prediction is taken for the truth and the other way round."""
    return _add(counts, fp="fn", fn="fp")


def swapped_metrics(counts: DataFrame) -> DataFrame:
    """The metrics a caller gets who hands label and prediction over in the wrong order.

    Kept because published figures of the model were made that way: precision and recall
    change places, and both areas belong to the swapped roles. Zero stands for a missing rate.
    """
    swapped = hard_areas(classification_metrics(swap_roles(counts)))
    names = [c for c in counts.columns if c not in CELLS]
    return swapped.selectExpr(
        *names,
        "coalesce(accuracy, 0D) AS acc", "coalesce(f1, 0D) AS f1",
        "coalesce(precision, 0D) AS precision", "coalesce(recall, 0D) AS recall",
        "area_under_roc AS auc", "area_under_pr AS arp",
    )


def _class_sums(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.expr(f"count_if({label} = 1) AS p"), F.expr(f"count_if({label} = 0) AS n"))


def _partition(columns: Sequence[str]) -> str:
    return f"PARTITION BY {', '.join(columns)}" if columns else ""


def _areas_from_steps(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Trapezoid areas from curve steps ``(p, n, cum_p, cum_n)``, one per score, falling.

    The point before a step is the cumulated count without the step's own rows, so the areas
    are plain sums and need no ordering here.
    """
    precision = ratio("cum_p", "cum_p + cum_n")
    before = f"coalesce({ratio('cum_p - p', 'cum_p - p + cum_n - n')}, {precision})"
    roc = "sum(CAST(n AS DOUBLE) * (CAST(cum_p AS DOUBLE) - CAST(p AS DOUBLE) / 2D))"
    pr = f"sum(CAST(p AS DOUBLE) * ({precision} + {before}) / 2D)"
    return steps.groupBy(*by).agg(
        F.expr(f"try_divide({roc}, CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS area_under_roc"),
        F.expr(f"try_divide({pr}, CAST(sum(p) AS DOUBLE)) AS area_under_pr"),
    )


def score_areas(df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = LABEL,
                bins: int = 1000) -> DataFrame:
    """Areas under ROC and PR of a score in [0, 1], by equal-width score bins.

    After the first aggregate at most ``bins`` rows per group are left; the running sums
    work on those only.
    """
    binned = df.filter(f"{score} IS NOT NULL").selectExpr(
        *by, label, f"least(CAST(floor({score} * {bins}) AS INT), {bins - 1}) AS bin"
    )
    falling = f"OVER ({_partition(by)} ORDER BY bin DESC ROWS UNBOUNDED PRECEDING)"
    steps = _class_sums(binned, [*by, "bin"], label)
    return _areas_from_steps(_add(steps, cum_p=f"sum(p) {falling}", cum_n=f"sum(n) {falling}"), by)


def score_curve(df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = LABEL) -> DataFrame:
    """The curve of a score, one point for each distinct value: ``(by..., score, p, n, cum_p, cum_n)``.

    ``p`` and ``n`` count the rows of both classes at the score, ``cum_p`` and ``cum_n`` those at it or
    above. One ordered running sum over all scores would be one task's work. The points are cut instead
    at bounds that deal them evenly, the same for every group. Each part is summed on its own and
    shifted by the totals of the parts above, one row each. The points are staged, so the input is read
    once and a task run again finds the same bounds; only these, one fewer than the parts, come to the driver.
    """
    points = stage(_class_sums(df.filter(f"{score} IS NOT NULL"), [*by, score], label), "score-points")
    parts = _score_parts(points, score)
    above = f"OVER ({_partition(by)} ORDER BY part DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    totals = parts.groupBy(*by, "part").agg(F.expr("sum(p) AS p"), F.expr("sum(n) AS n"))
    offsets = totals.selectExpr(
        *[f"{c} AS _{c}" for c in by], "part AS _part",
        f"coalesce(sum(p) {above}, 0L) AS p_before", f"coalesce(sum(n) {above}, 0L) AS n_before",
    )
    inside = f"OVER ({_partition([*by, 'part'])} ORDER BY {score} DESC ROWS UNBOUNDED PRECEDING)"
    # Null-safe, as NULL may name a group. The offsets are small, but their number grows with
    # the groups, so whether to broadcast them is left to their size.
    shifted = parts.join(offsets, F.expr(" AND ".join(f"{c} <=> _{c}" for c in [*by, "part"])))
    return shifted.selectExpr(*by, score, "p", "n", f"p_before + sum(p) {inside} AS cum_p", f"n_before + sum(n) {inside} AS cum_n")


def _score_parts(points: DataFrame, score: str) -> DataFrame:
    """``points`` and ``part``, a number that rises with the score; parts hold about equally many points."""
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = ", ".join(f"{i / parts!r}D" for i in range(1, parts)) or "0.5D"
    value = f"CAST({score} AS DOUBLE)"
    bounds = points.filter(f"NOT isnan({value})").selectExpr(
        f"approx_percentile({value}, array({shares}), {max(10_000, 20 * parts)})").first()[0]
    splits = [-math.inf, *sorted({bound for bound in bounds or [0.0] if math.isfinite(bound)} or {0.0}), math.inf]
    # NaN sorts above all numbers, and its bucket is the last one.
    cut = Bucketizer(splits=splits, inputCol="_value", outputCol="_bucket", handleInvalid="keep")
    return cut.transform(_add(points, _value=value)).selectExpr(*points.columns, "CAST(_bucket AS INT) AS part")


def score_areas_exact(df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = LABEL) -> DataFrame:
    """The same areas with every distinct score as a step of its own; see :func:`score_curve`."""
    return _areas_from_steps(score_curve(df, by, score, label), by)


def curve_rates(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``precision``, ``recall`` and ``fall_out`` of accepting each point's score and all above it."""
    totals = curve.groupBy(*by).agg(F.expr("sum(p) AS _p"), F.expr("sum(n) AS _n"))
    if by:
        named = totals.selectExpr(*[f"{c} AS _{c}" for c in by], "_p", "_n")
        rated = curve.join(named, F.expr(" AND ".join(f"{c} <=> _{c}" for c in by))).drop(*[f"_{c}" for c in by])
    else:
        rated = _add(curve, **{name: f"{count or 0}L" for name, count in totals.first().asDict().items()})
    return _add(rated, precision=ratio("cum_p", "cum_p + cum_n"), recall=ratio("cum_p", "_p"),
                fall_out=ratio("cum_n", "_n")).drop("_p", "_n")


def error_rates(counts: DataFrame, max_fp_rate: float = MAX_FALSE_POSITIVE_RATE,
                max_fn_rate: float = MAX_FALSE_NEGATIVE_RATE) -> DataFrame:
    """Add the error rates (of normal and of fraud rows) and whether they meet the limits.

    Fraud without a prediction counts as missed where it was counted.
    """
    missed = "fn + unscored_fraud" if set(UNSCORED) <= set(counts.columns) else "fn"
    rated = _add(counts, fp_rate=ratio("fp", "fp + tn"), fn_rate=ratio(missed, f"tp + {missed}"))
    meets = f"coalesce(fp_rate < {max_fp_rate!r}D AND fn_rate < {max_fn_rate!r}D, false)"
    return _add(rated, meets_limits=meets)


def monthly_missed_loss(df: DataFrame, by: Sequence[str] = (), limit: float = MAX_MONTHLY_LOSS,
                        label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Amount of fraud that was not predicted, by month, against a limit.

    Fraud without a prediction was missed too; a missing amount adds nothing to the loss.
    """
    missed = df.filter(f"{label} = 1 AND NOT coalesce({prediction} = 1, false)").selectExpr(
        *by, f"date_format({EVENT_TIME}, 'yyyy-MM') AS month", f"nanvl(coalesce({AMOUNT}, 0D), 0D) AS {AMOUNT}"
    )
    totals = missed.groupBy(*by, "month").agg(F.expr("count(*) AS missed"), F.expr(f"sum({AMOUNT}) AS loss"))
    return _add(totals, within_limit=f"loss < {float(limit)!r}D")


def metrics_long(metrics: DataFrame, run: str) -> DataFrame:
    """Metric columns as rows ``(run, metric, value)``, ready to append to a run table."""
    names = [c for c in metrics.columns if c != run]
    as_double = metrics.selectExpr(f"{run} AS run", *[f"CAST({c} AS DOUBLE) AS {c}" for c in names])
    return as_double.unpivot("run", names, "metric", "value")
