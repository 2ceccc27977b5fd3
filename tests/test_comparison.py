from __future__ import annotations

import math
import statistics

import pytest
from pyspark.sql import functions as F

from cardloom.operators.comparison import (
    bootstrap_counts, bootstrap_counts_by_cell, compare_models, promotion_gate, sample_scores, score_histogram,
    score_intervals,
)
from cardloom.operators.evaluation import CELLS, confusion_counts

SCORES = "model STRING, replicate INT, score DOUBLE"


def predictions(spark, n=20000, partitions=4):
    return spark.range(0, n, 1, partitions).selectExpr(
        "'m' AS model", "id AS transaction_id", "CAST(id % 5 = 0 AS INT) AS tx_fraud",
        "CAST(id % 7 = 0 OR id % 10 = 0 AS DOUBLE) AS prediction",
    )


@pytest.mark.parametrize("draw", [bootstrap_counts, bootstrap_counts_by_cell])
def test_samples_follow_the_poisson_law(spark, draw):
    """Each cell count is Poisson with mean fraction * rows, so mean and variance agree."""
    rows = predictions(spark)
    whole = confusion_counts(rows).first().asDict()
    samples = draw(rows).collect()
    assert sorted(r.replicate for r in samples) == list(range(100))
    for cell in CELLS:
        mean = whole[cell] * 0.01
        got = [r[cell] for r in samples]
        assert statistics.fmean(got) == pytest.approx(mean, abs=4 * (mean / 100) ** 0.5)
        assert statistics.variance(got) == pytest.approx(mean, rel=0.75)


def test_bootstrap_does_not_depend_on_partitioning(spark):
    one = bootstrap_counts(predictions(spark, partitions=1)).collect()
    many = bootstrap_counts(predictions(spark).repartition(11)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_models_are_drawn_independently(spark):
    rows = predictions(spark)
    both = rows.union(rows.withColumn("model", F.lit("other")))
    got = {}
    for r in bootstrap_counts(both).collect():
        got.setdefault(r.model, []).append((r.replicate, r.tp, r.fp, r.fn, r.tn))
    assert sorted(got["m"]) != sorted(got["other"])


def test_bootstrap_shuffles_partial_counts_only(spark, tmp_path):
    predictions(spark).write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p"))
    plan = bootstrap_counts(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "Join" not in plan


def table(spark, first, second):
    rows = [("b", i, x) for i, x in enumerate(first)] + [("c", i, x) for i, x in enumerate(second)]
    return spark.createDataFrame(rows, SCORES)


def tail_area(t, freedom, steps=200000):
    """Two-sided tail of Student's t by the trapezoid rule on its density."""
    scale = math.gamma((freedom + 1) / 2) / (math.sqrt(freedom * math.pi) * math.gamma(freedom / 2))
    density = [scale * (1 + (t * i / steps) ** 2 / freedom) ** (-(freedom + 1) / 2) for i in range(steps + 1)]
    return 1 - 2 * t / steps * (sum(density) - (density[0] + density[-1]) / 2)


def test_t_test_by_hand(spark):
    a, b = [0.5, 0.6, 0.7, 0.4], [0.9, 0.8, 0.7]
    row = compare_models(table(spark, a, b), "b", "c").first()
    pooled = (3 * statistics.variance(a) + 2 * statistics.variance(b)) / 5
    t = (statistics.fmean(a) - statistics.fmean(b)) / (pooled * (1 / 4 + 1 / 3)) ** 0.5
    assert row.t == pytest.approx(t) and row.freedom == 5
    assert row.p_value == pytest.approx(tail_area(abs(t), 5), abs=1e-6)


@pytest.mark.parametrize("shift,differs,promote", [(0.2, True, True), (-0.2, True, False), (0.0001, False, False)])
def test_gate_needs_a_better_candidate(spark, shift, differs, promote):
    base = [0.5 + 0.01 * (i % 7) for i in range(100)]
    test = compare_models(table(spark, base, [x + shift for x in base]), "b", "c")
    row = promotion_gate(test).first()
    assert (row.differs, row.promote) == (differs, promote)


def test_gate_without_spread_or_samples(spark):
    same = promotion_gate(compare_models(table(spark, [0.5, 0.5], [0.5, 0.5]), "b", "c")).first()
    assert same.t is None and same.p_value is None and not same.differs and not same.promote
    apart = promotion_gate(compare_models(table(spark, [0.5, 0.5], [0.7, 0.7]), "b", "c")).first()
    assert apart.t == -math.inf and apart.p_value == pytest.approx(0) and apart.differs and apart.promote
    for first, second in (([0.5], []), ([0.5], [0.7]), ([], [])):
        few = promotion_gate(compare_models(table(spark, first, second), "b", "c")).first()
        assert few.p_value is None and not few.differs and not few.promote


def test_interval(spark):
    base = [0.5 + 0.01 * (i % 7) for i in range(100)]
    row = score_intervals(table(spark, base, []).filter("model = 'b'")).first()
    half = 1.984217 * statistics.pstdev(base) / 10
    assert (row.samples, row.mean) == (100, pytest.approx(statistics.fmean(base)))
    assert (row.low, row.high) == (pytest.approx(row.mean - half, abs=1e-7), pytest.approx(row.mean + half, abs=1e-7))


def test_interval_with_fewer_samples(spark):
    row = score_intervals(table(spark, [0.1, 0.2, 0.3], [])).first()
    assert row.high - row.mean == pytest.approx(4.302653 * statistics.pstdev([0.1, 0.2, 0.3]) / 3**0.5, abs=1e-6)


def test_swapped_scores_differ_and_histogram_is_complete(spark):
    counts = bootstrap_counts(predictions(spark))
    plain = {r.replicate: r.score for r in sample_scores(counts).collect()}
    swapped = {r.replicate: r.score for r in sample_scores(counts, swapped=True).collect()}
    assert plain.keys() == swapped.keys() and plain != swapped
    histogram = score_histogram(sample_scores(counts)).collect()
    assert sum(r.samples for r in histogram) == 100
    assert all(0 <= r.bin < 20 for r in histogram)


def test_intervals_of_many_samples(spark):
    from cardloom.functions.stats import t_critical
    from cardloom.operators.comparison import score_intervals

    rows = spark.range(250).selectExpr("'m' AS model", "id AS replicate", "id / 250D AS score")
    got = score_intervals(rows).first()
    spread = rows.selectExpr("stddev_pop(score)").first()[0]
    half = t_critical(0.95, 249) * spread / 250**0.5
    assert got.samples == 250 and got.high - got.mean == pytest.approx(half, rel=1e-6)
