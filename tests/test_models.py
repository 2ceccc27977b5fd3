from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardloom.functions.scoring import LinearModel
from cardloom.operators.evaluation import classification_metrics, confusion_counts
from cardloom.operators.features import NUMERIC_FEATURES, fit_features
from cardloom.operators.modelling import (
    classifier, coefficient_rows, fit_scorer, fraud_probability, grid_areas, last_stage, load_model, param_rows, save_model, summary_rows, tune,
)
from cardloom.operators.sampling import class_weights
from cardloom.plans import clean, monitor, stream, train, validate
from cardloom.plans.train import TrainOptions, known_model_options, prepare, train_model
from cardloom.sources.events import feed_lines, load_transactions
from cardloom.sources.feed import write_feed_lines
from cardloom.sources.tables import cached, read_runs, read_table, stage, write_run, write_table
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def cleaned(spark):
    from cardloom.functions.rules import strict_rules
    from cardloom.operators.cleaning import clean as clean_rows

    return stage(clean_rows(load_transactions(spark, SF_SMALL), strict_rules()), "test-cleaned")


def test_terms_and_baseline_parameters(cleaned):
    model = fit_scorer(class_weights(cleaned), "class_weight")
    assert [r.term for r in coefficient_rows(model).collect()] == [*NUMERIC_FEATURES, "intercept"]
    lr = last_stage(model)
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam()) == (1, 0.2, 0.8)
    params = {r.param: r.value for r in param_rows(model, "r").collect()}
    assert params["regParam"] == "0.2" and params["maxIter"] == "1"


def test_scenario_terms(cleaned):
    model = fit_scorer(cleaned, with_scenario=True)
    terms = [r.term for r in coefficient_rows(model).collect()]
    assert terms[:3] == list(NUMERIC_FEATURES) and terms[3] == "scenario_0" and len(terms) == 7


def test_summary_matches_own_metrics(cleaned):
    model = fit_scorer(cleaned, regParam=0.0, maxIter=20)
    summary = {r.metric: r.value for r in summary_rows(model, "r").collect()}
    own = classification_metrics(confusion_counts(model.transform(cleaned))).first()
    assert summary["training_accuracy"] == pytest.approx(own.accuracy)
    assert 0.5 < summary["training_area_under_roc"] <= 1


def test_saved_model_scores_raw_rows(cleaned, tmp_path):
    model = fit_scorer(cleaned, regParam=0.01, maxIter=10)
    save_model(model, str(tmp_path / "m"))
    save_model(model, str(tmp_path / "m"))  # overwrite

    def scores(m):
        return {r[0]: (r[1], r[2]) for r in m.transform(cleaned).select(
            "transaction_id", fraud_probability(), "prediction").collect()}

    assert scores(load_model(str(tmp_path / "m"))) == scores(model)


def test_linear_model_equals_the_pipeline(spark, cleaned):
    """A fitted model turned into weights on raw columns gives the same scores."""
    model = fit_scorer(cleaned, regParam=0.01, maxIter=10)
    scaler, lr = model.stages[-2], last_stage(model)
    span = [hi - lo for hi, lo in zip(scaler.originalMax, scaler.originalMin)]
    weights = [c / s for c, s in zip(lr.coefficients, span)]
    intercept = lr.intercept - sum(w * lo for w, lo in zip(weights, scaler.originalMin))
    linear = LinearModel(dict(zip(NUMERIC_FEATURES, map(float, weights))), float(intercept))
    both = model.transform(cleaned).select("*", fraud_probability().alias("p")).selectExpr(
        f"abs(p - ({linear.score()})) AS d", f"prediction = {linear.prediction()} AS same")
    assert both.selectExpr("max(d)", "bool_and(same)").first() == (pytest.approx(0, abs=1e-9), True)


def test_unregularised_fit_has_no_gradient(cleaned):
    """At the optimum the residuals are orthogonal to every feature, weights included."""
    rows = class_weights(cleaned)
    model = fit_scorer(rows, "class_weight", regParam=0.0, elasticNetParam=0.0, maxIter=300, tol=1e-12)
    residual = model.transform(rows).select(
        "*", fraud_probability().alias("p"), vector_to_array("features").alias("x")
    ).selectExpr("class_weight * (tx_fraud - p) AS r", "x")
    sums = residual.selectExpr("avg(r)", "avg(r * x[0])", "avg(r * x[1])", "avg(r * x[2])").first()
    assert all(abs(value) < 1e-4 for value in sums)


def test_tuning_covers_the_grid(cleaned):
    tuned = tune(class_weights(cleaned), "class_weight", parallelism=4, keep_sub_models=True)
    assert len(tuned.sub_models) == 18
    rows = tuned.candidates.collect()
    assert len(rows) == 18 and len({(r.reg_param, r.fit_intercept, r.elastic_net) for r in rows}) == 18
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].area_under_pr == max(r.area_under_pr for r in rows)
    lr = last_stage(tuned.model)
    assert (lr.getRegParam(), lr.getFitIntercept(), lr.getElasticNetParam()) == (
        best[0].reg_param, best[0].fit_intercept, best[0].elastic_net)
    assert tuned.model.transform(cleaned).count() == cleaned.count()  # scores raw rows


def test_default_preparation_leaves_the_test_rows_alone(cleaned):
    rows, held_out = prepare(cleaned, TrainOptions())
    ids = [{r.transaction_id for r in part.collect()} for part in (rows, held_out)]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == cleaned.count() == rows.count() + held_out.count()


def test_known_order_splits_copies(cleaned):
    rows, held_out = prepare(cleaned, known_model_options(fraction=1.0))
    ids = [{r.transaction_id for r in part.filter("tx_fraud = 1").collect()} for part in (rows, held_out)]
    assert ids[0] & ids[1]  # copies of one transaction on both sides
    assert "_copy" not in rows.columns
    assert len(coefficient_rows(train_model(cleaned, known_model_options(1.0)).model).collect()) == 7


def test_oversampling_and_weights_agree(cleaned):
    a = train_model(cleaned, TrainOptions(oversample=True)).model
    b = train_model(cleaned, TrainOptions()).model
    for x, y in zip(last_stage(a).coefficients, last_stage(b).coefficients):
        assert x == pytest.approx(y, abs=5e-3)


def test_cached_releases(cleaned):
    with cached(cleaned.select("transaction_id")) as (kept,):
        assert kept.storageLevel.useMemory and kept.count() > 0
    assert not kept.storageLevel.useMemory


def test_jobs_end_to_end(spark, tmp_path):
    feed, table, model, metrics = (str(tmp_path / n) for n in ("feed", "clean", "model", "metrics"))
    write_feed_lines(feed_lines(load_transactions(spark, SF_SMALL)), feed)
    rows = clean.clean_feed(spark, feed, table, wide_ids=True)
    assert rows.count() > 800
    for _ in range(2):
        train.run(spark, table, model, metrics, str(tmp_path / "params"))
    logged = read_table(spark, metrics)
    assert logged.filter("metric = 'recall'").count() == 2  # appended
    accepted = validate.run(spark, table, str(tmp_path / "validation"))
    decision = read_table(spark, str(tmp_path / "validation/decision")).first()
    assert accepted == decision.promote == decision.is_valid
    assert (tmp_path / "validation/best_model").exists() == accepted
    assert read_table(spark, str(tmp_path / "validation/scores")).count() == 200
    assert read_table(spark, str(tmp_path / "validation/intervals")).count() == 2
    written = {r.metric for r in read_runs(spark, str(tmp_path / "validation/metrics")).where("run = 'baseline'").collect()}
    assert {"training_accuracy", "training_area_under_roc", "recall_of_all", "area_under_pr"} <= written
    goals = read_runs(spark, str(tmp_path / "validation/goals"))
    assert goals.count() == 2 and {"fp_rate", "fn_rate", "meets_limits", "run_id", "run_time"} <= set(goals.columns)
    losses = read_runs(spark, str(tmp_path / "validation/losses"))
    assert losses.where("missed > 0 AND within_limit IS NOT NULL").count() == losses.count() > 0

    # score the cleaned rows as a stream of files
    query = stream.start(spark, model, "parquet", "parquet", str(tmp_path / "state"), table, str(tmp_path / "scored"))
    query.awaitTermination()
    assert read_table(spark, str(tmp_path / "scored")).count() == rows.count()
    windows = monitor.monitor(spark, str(tmp_path / "scored"), str(tmp_path / "windows"), str(tmp_path / "w-state"))
    assert 20 < windows.count() <= 31


def test_write_table_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    for mode, count in (("overwrite", 3), ("append", 6), ("overwrite", 3)):
        write_table(spark.range(3), path, mode=mode)
        assert read_table(spark, path).count() == count


def test_tuning_does_not_depend_on_partitions(spark, cleaned):
    from cardloom.operators.modelling import tune
    from cardloom.operators.sampling import class_weights

    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in (3, 16):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            rows = class_weights(cleaned.repartition(partitions, "transaction_id"))
            tuned = tune(rows, "class_weight", parallelism=4)
            found.append([round(r.area_under_pr, 6) for r in tuned.candidates.orderBy("candidate").collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_grid_areas_match_the_evaluator(spark, cleaned):
    """Areas of many candidates from one scan, against one evaluation of all scores for each."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    features = fit_features(cleaned).transform(cleaned)
    models = [classifier(maxIter=n, regParam=r, elasticNetParam=e).fit(features)
              for n, r, e in ((1, 0.05, 0.0), (1, 0.5, 1.0), (10, 0.01, 0.5), (20, 0.0, 0.0))]
    got = {r.candidate: r for r in grid_areas(
        features, [(list(map(float, m.coefficients)), float(m.intercept)) for m in models]).collect()}
    for at, model in enumerate(models):
        for metric, column in (("areaUnderROC", "area_under_roc"), ("areaUnderPR", "area_under_pr")):
            want = BinaryClassificationEvaluator(labelCol="tx_fraud", metricName=metric, numBins=0).evaluate(model.transform(features))
            assert got[at][column] == pytest.approx(want, abs=2e-3)
    assert grid_areas(features.where("false"), [([1.0, 0.0, 0.0], 0.0)]).count() == 0
    flat = grid_areas(features, [([0.0, 0.0, 0.0], 3.0)]).first()
    assert flat.area_under_roc == pytest.approx(0.5)


def test_grid_areas_sort_bins_only(cleaned):
    features = fit_features(cleaned).transform(cleaned)
    plan = grid_areas(features, [([1.0, 2.0, 0.5], 0.0), ([0.5, -1.0, 0.0], 1.0)])._jdf.queryExecution().executedPlan().toString()
    # Plans are printed from the result down: the aggregate by bin comes before (below) the sort.
    assert plan.count("FileScan parquet") == 1 and plan.index("Sort [") < plan.rindex("HashAggregate(keys=[candidate")


def test_a_repeated_run_replaces_its_rows_only(spark, tmp_path):
    path = str(tmp_path / "runs")

    def rows(value):
        return spark.createDataFrame([("m", "recall", value), ("m", "f1", value)], "run STRING, metric STRING, value DOUBLE")

    for run_id, value in (("007", 1.0), ("1e5", 2.0), ("007", 3.0), ("a-b", 4.0)):
        write_run(rows(value), path, run_id)
    got = read_runs(spark, path).groupBy("run_id").agg(F.sum("value").alias("s"), F.count("*").alias("n"), F.count("run_time").alias("t"))
    assert {(r.run_id, r.s, r.n, r.t) for r in got.collect()} == {("007", 6.0, 2, 2), ("1e5", 4.0, 2, 2), ("a-b", 8.0, 2, 2)}


def test_hold_out_metrics_count_every_test_row(spark, cleaned):
    some = cleaned.withColumn("tx_amount", F.expr("IF(transaction_id % 7 = 0, CAST(NULL AS DOUBLE), tx_amount)"))
    trained = train_model(some)
    got = {r.metric: r.value for r in train.evaluate(trained, "r").collect()}
    cells = sum(got[name] for name in ("tp", "fp", "fn", "tn", "unscored_fraud", "unscored_normal"))
    assert cells == trained.test.count() and got["unscored_normal"] > 0 and 0.5 < got["scored_share"] < 1
