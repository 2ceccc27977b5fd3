from __future__ import annotations

import random

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cardloom.functions.stats import hard_area_under_pr, hard_area_under_roc, t_critical, t_inside, t_two_sided_p
from cardloom.operators.evaluation import (
    classification_metrics, confusion_counts, error_rates, hard_areas, metrics_long, monthly_missed_loss,
    curve_rates, score_areas, score_areas_exact, score_curve, swapped_metrics,
)

# (tp, fp, fn, tn), area under PR, area under ROC, as Spark's own metrics give them
KNOWN = [
    ((6, 5, 2, 20), 0.507576, 0.775), ((6, 2, 5, 20), 0.655303, 0.727273), ((0, 0, 3, 7), 0.3, 0.5),
    ((0, 4, 0, 6), 0.0, 0.0), ((3, 0, 2, 0), 1.0, 1.0), ((4, 3, 0, 0), 0.571429, 0.5),
    ((0, 2, 3, 5), 0.15, 0.357143), ((0, 0, 0, 9), 0.0, 0.0),
]
COUNTS = "tp BIGINT, fp BIGINT, fn BIGINT, tn BIGINT"


def rows_of(spark, tp, fp, fn, tn):
    pairs = [(1, 1.0)] * tp + [(0, 1.0)] * fp + [(1, 0.0)] * fn + [(0, 0.0)] * tn
    return spark.createDataFrame(pairs, "tx_fraud INT, prediction DOUBLE")


@pytest.mark.parametrize("cells,pr,roc", KNOWN)
def test_hard_areas(spark, cells, pr, roc):
    counts = confusion_counts(rows_of(spark, *cells))
    row = hard_areas(counts).first()
    assert (row.tp, row.fp, row.fn, row.tn) == cells
    assert row.area_under_pr == pytest.approx(pr, abs=1e-6)
    assert row.area_under_roc == pytest.approx(roc, abs=1e-6)


def curve(tp, fp, fn, tn):
    """Areas by walking the two steps of the curve."""
    pos, neg = tp + fn, fp + tn
    steps = [(tp, fp)] if tp + fp else []
    steps += [(pos, neg)] if fn + tn else []
    roc = pr = 0.0
    x = y = rec = 0.0
    prec = None
    for c_p, c_n in steps:
        y1, x1 = (c_p / pos if pos else 0.0), (c_n / neg if neg else 0.0)
        p1 = c_p / (c_p + c_n)
        prec = p1 if prec is None else prec
        roc += (x1 - x) * (y + y1) / 2
        pr += (y1 - rec) * (prec + p1) / 2
        x, y, rec, prec = x1, y1, y1, p1
    return roc, pr


def test_hard_areas_of_many_tables(spark):
    rng = random.Random(3)
    tables = [tuple(rng.randint(0, 9) for _ in range(4)) for _ in range(300)]
    tables = [t for t in tables if t[0] + t[2] and t[1] + t[3]]
    got = spark.createDataFrame(tables, COUNTS).selectExpr(
        "tp", "fp", "fn", "tn", f"{hard_area_under_roc()} AS roc", f"{hard_area_under_pr()} AS pr"
    ).collect()
    for row in got:
        roc, pr = curve(row.tp, row.fp, row.fn, row.tn)
        assert row.roc == pytest.approx(roc) and row.pr == pytest.approx(pr)


def test_swapped_roles(spark):
    counts = spark.createDataFrame([(6, 5, 2, 20)], COUNTS)
    plain, swapped = classification_metrics(counts).first(), swapped_metrics(counts).first()
    assert (plain.precision, plain.recall) == (pytest.approx(6 / 11), pytest.approx(0.75))
    assert (swapped.precision, swapped.recall) == (pytest.approx(0.75), pytest.approx(6 / 11))
    assert swapped.acc == plain.accuracy and swapped.f1 == pytest.approx(plain.f1)
    assert swapped.auc == pytest.approx(0.727273, abs=1e-6) and swapped.arp == pytest.approx(0.655303, abs=1e-6)


def test_rates_without_a_base_are_null(spark):
    row = classification_metrics(spark.createDataFrame([(0, 0, 0, 0)], COUNTS)).first()
    assert row.accuracy is None and row.precision is None and row.recall is None and row.f1 is None
    assert confusion_counts(rows_of(spark, 1, 0, 0, 0).filter("prediction > 5")).first().tp == 0


def scored(spark, n=4000, distinct=None):
    u = "pmod(xxhash64(id), 1000003) / 1000003D"
    score = f"floor({u} * {distinct}) / {distinct}D" if distinct else u
    return spark.range(n).selectExpr(
        f"{score} AS score", f"CAST(pmod(xxhash64(id, 'y'), 1000) / 1000D < 0.1 + 0.5 * {u} AS INT) AS tx_fraud"
    )


@pytest.mark.parametrize("distinct", [None, 7])
def test_score_areas_match_the_evaluator(spark, distinct):
    rows = scored(spark, distinct=distinct)
    exact, binned = score_areas_exact(rows).first(), score_areas(rows).first()
    for metric, column in (("areaUnderROC", "area_under_roc"), ("areaUnderPR", "area_under_pr")):
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="tx_fraud", metricName=metric,
                                                  numBins=0)
        want = evaluator.evaluate(rows)
        assert exact[column] == pytest.approx(want, abs=1e-9)
        assert binned[column] == pytest.approx(want, abs=2e-3)


def test_score_areas_of_groups_with_clustered_scores(spark):
    rows = scored(spark).selectExpr("'a' AS model", "*").union(
        scored(spark).selectExpr("'b' AS model", "0.5 + score / 1000000", "tx_fraud")
    )
    got = {r.model: r for r in score_areas_exact(rows, by=["model"]).collect()}
    assert got["a"].area_under_roc == pytest.approx(got["b"].area_under_roc)  # same order of rows
    assert got["a"].area_under_pr == pytest.approx(got["b"].area_under_pr)


def test_curve_points_are_running_sums_over_all_scores(spark):
    rows = scored(spark).selectExpr("if(score < 0.2, NULL, 'm') AS model", "*").union(
        spark.sql("SELECT 'x' AS model, double('NaN') AS score, 1 AS tx_fraud UNION ALL SELECT 'x', 0.5D, 0 UNION ALL SELECT 'x', NULL, 0"))
    points = curve_rates(score_curve(rows, by=["model"]), by=["model"]).collect()
    for model in (None, "m", "x"):
        own = sorted((r for r in points if r.model == model), key=lambda r: (math.isnan(r.score), r.score), reverse=True)
        p = n = 0
        for point in own:
            p, n = p + point.p, n + point.n
            assert (point.cum_p, point.cum_n) == (p, n)
            assert point.precision == pytest.approx(p / (p + n))
        assert own[-1].recall == own[-1].fall_out == 1
    assert math.isnan([r for r in points if r.model == "x" and r.cum_p + r.cum_n == 1][0].score)
    single = curve_rates(score_curve(scored(spark))).agg({"recall": "max", "fall_out": "max"}).first()
    assert tuple(single) == (1.0, 1.0)


def test_curve_shuffles_points_once_after_they_are_stored(spark):
    plan = score_curve(scored(spark), by=[])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    # the points themselves once; the others carry one row a part
    assert plan.count("Window [sum(p") == 2 and plan.count("Exchange hashpartitioning(part") == 2


def test_curve_of_nothing(spark):
    none = scored(spark).where("score > 2")
    assert score_curve(none).count() == 0 and curve_rates(score_curve(none)).count() == 0


def test_null_names_a_group_too(spark):
    rows = scored(spark).selectExpr("if(score < 0.4, NULL, 'm') AS model", "*")
    assert {r.model for r in score_areas_exact(rows, by=["model"]).collect()} == {None, "m"}
    assert {r.model for r in score_areas(rows, by=["model"]).collect()} == {None, "m"}


def test_score_areas_with_one_class(spark):
    row = score_areas(scored(spark).filter("tx_fraud = 0")).first()
    assert row.area_under_roc is None and row.area_under_pr is None


def test_error_rates(spark):
    got = error_rates(spark.createDataFrame([(99, 4, 1, 96), (97, 0, 3, 100), (0, 0, 0, 9)], COUNTS)).collect()
    assert [(r.fp_rate, r.fn_rate, r.meets_limits) for r in got] == [
        (0.04, 0.01, True), (0.0, 0.03, False), (0.0, None, False)
    ]


def test_monthly_missed_loss(make_transactions):
    from datetime import datetime

    rows = make_transactions(
        {"tx_fraud": 1, "tx_amount": 300_000.0}, {"tx_fraud": 1, "tx_amount": 250_000.0},
        {"tx_fraud": 1, "tx_amount": 5.0, "tx_datetime": datetime(2024, 2, 29, 23)}, {"tx_fraud": 0},
    ).withColumn("prediction", F.lit(0.0))
    got = {r.month: (r.missed, r.loss, r.within_limit) for r in monthly_missed_loss(rows).collect()}
    assert got == {"2024-01": (2, 550_000.0, False), "2024-02": (1, 5.0, True)}


def test_metrics_long(spark):
    wide = classification_metrics(spark.createDataFrame([("m", 1, 0, 0, 1)], "model STRING, " + COUNTS))
    got = {r.metric: r.value for r in metrics_long(wide, "model").collect() if r.run == "m"}
    assert got == {"tp": 1, "fp": 0, "fn": 0, "tn": 1, "accuracy": 1, "precision": 1, "recall": 1, "f1": 1}


@settings(max_examples=30, deadline=None)
@given(st.floats(0.5, 0.999), st.integers(1, 300))
def test_t_critical_inverts(confidence, freedom):
    assert t_inside(t_critical(confidence, freedom), freedom) == pytest.approx(confidence, abs=1e-9)


def test_t_tables(spark):
    assert t_critical(0.95, 99) == pytest.approx(1.984217, abs=1e-6)
    assert t_critical(0.99, 198) == pytest.approx(2.600887, abs=1e-6)
    assert t_critical(0.95, 1) == pytest.approx(12.7062, abs=1e-4)
    assert t_critical(0.95, 2) == pytest.approx(4.302653, abs=1e-6)
    assert t_critical(0.95, 3) == pytest.approx(3.182446, abs=1e-6)
    cases = [(t, f) for t in (0.0, 0.3, -1.7, 2.600887, 30.0) for f in (1, 2, 3, 4, 5, 98, 199, 198)]
    got = spark.createDataFrame(cases, "t DOUBLE, freedom INT").selectExpr(
        "t", "freedom", f"{t_two_sided_p('t', 'freedom')} AS p").collect()
    for row in got:
        assert row.p == pytest.approx(1 - t_inside(abs(row.t), row.freedom), abs=1e-12)


def test_unscored_rows_are_in_cells_of_their_own(spark):
    pairs = [(1, 1.0)] * 6 + [(0, 1.0)] * 2 + [(1, 0.0)] * 3 + [(0, 0.0)] * 9 + [(1, None)] * 3 + [(0, None)] * 2 + [(None, 1.0)]
    rows = spark.createDataFrame(pairs, "tx_fraud INT, prediction DOUBLE")
    counts = confusion_counts(rows, unscored=True)
    assert tuple(counts.first()) == (6, 2, 3, 9, 3, 2)
    row = error_rates(classification_metrics(counts)).first()
    assert (row.recall, row.recall_of_all) == (pytest.approx(6 / 9), pytest.approx(6 / 12))
    assert (row.scored_share, row.fn_rate) == (pytest.approx(20 / 25), pytest.approx(6 / 12))
    assert confusion_counts(rows).columns == ["tp", "fp", "fn", "tn"]
    nothing = classification_metrics(confusion_counts(rows.where("false"), unscored=True)).first()
    assert nothing.unscored_fraud == 0 and nothing.scored_share is None
