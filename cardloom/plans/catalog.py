"""The registered queries, by name. Each reads whole tables of one data folder.

Sampling queries hash with md5 here, so that another SQL engine can repeat them; the jobs
use the cheaper default. Timestamps leave as TIMESTAMP_NTZ (UTC) and computed fractions are
rounded to six digits, which makes results comparable across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardloom.functions.hashing import unit_uniform
from cardloom.functions.rules import parity_rules, strict_rules
from cardloom.functions.scoring import LinearModel
from cardloom.operators import cleaning, comparison, evaluation, profile, sampling
from cardloom.operators.features import (
    FEATURES, NUMERIC_FEATURES, RAW_FEATURES, SCENARIO_INDEX, SCENARIO_ONEHOT,
    fit_features, scenario_encoder, scenario_indexer, vector_columns,
)
from cardloom.operators.modelling import (
    GRID_ELASTIC_NET, GRID_FIT_INTERCEPT, GRID_REG_PARAM, TRAIN_RATIO, coefficient_rows, fit_scorer, grid_areas, load_model,
    save_model, score_rows, score_with_all, summary_rows, tune,
)
from cardloom.plans.clean import clean_feed, feed_reports, merge_new_files, parse_once
from cardloom.plans.monitor import monitor
from cardloom.plans.prepare import prepare_tables
from cardloom.plans.stream import start_routed
from cardloom.plans.train import WEIGHT, TrainOptions, known_model_options, prepare, train_model
from cardloom.plans.validate import validate
from cardloom.schema import COLUMNS, KEY, LABEL, transactions_schema
from cardloom.session import scratch_path, use_utc
from cardloom.sources.events import feed_lines, load_transactions, stream_transactions
from cardloom.sources.feed import read_feed, read_rejected_lines, write_feed_lines
from cardloom.sources.messages import decode_messages, encode_messages
from cardloom.sources.snapshots import read_snapshot
from cardloom.sources.tables import read_table, stage, write_bucketed, write_table
from cardloom.streaming.jobs import (
    clean_stream, drain_to_files, merge_key_sketches, merge_transactions, run_batches, window_metrics,
)

Query = Callable[[SparkSession, str], DataFrame]

# Two fixed models on raw columns, for results that another engine can recompute.
BASELINE = LinearModel({"tx_amount": 0.02, "tx_time_days": 0.01}, -2.0)
CANDIDATE = LinearModel({"tx_amount": 0.03, "tx_time_seconds": 0.0000001}, -4.0)
MODELS = {"baseline": BASELINE, "candidate": CANDIDATE}

FEATURE_COUNT = 6  # three numeric features and the one-hot vector of four scenarios
PORTABLE = "md5"
DIGITS = 6


def _present(df: DataFrame, round_all: bool = False) -> DataFrame:
    """Timestamps as UTC wall-clock time; with ``round_all`` every DOUBLE to six digits."""
    columns = []
    for field in df.schema:
        if isinstance(field.dataType, T.TimestampType):
            columns.append(f"CAST({field.name} AS TIMESTAMP_NTZ) AS {field.name}")
        elif round_all and isinstance(field.dataType, T.DoubleType):
            columns.append(f"round({field.name}, {DIGITS}) AS {field.name}")
        else:
            columns.append(f"`{field.name}`")
    return df.selectExpr(*columns)


def _cleaned(spark: SparkSession, sf_dir: str, strict: bool = True) -> DataFrame:
    return cleaning.clean(load_transactions(spark, sf_dir), strict_rules() if strict else parity_rules())


def _staged_clean(spark: SparkSession, sf_dir: str, strict: bool = True) -> DataFrame:
    """The cleaned table as files, for queries that read it more than once."""
    return stage(_cleaned(spark, sf_dir, strict), "cleaned")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of both fixed models: ``(model, score, prediction)`` beside the transaction."""
    return score_with_all(_cleaned(spark, sf_dir), MODELS, keep=COLUMNS)


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_counts(_scored(spark, sf_dir), by=["model"])


def _feed_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "feed")
    write_feed_lines(feed_lines(load_transactions(spark, sf_dir)), path)
    return path


# ---- sources and sinks


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(read_feed(spark, _feed_path(spark, sf_dir), transactions_schema(wide_ids=True)))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = read_rejected_lines(spark, _feed_path(spark, sf_dir), transactions_schema(wide_ids=True))
    return rejected.selectExpr("split(line, ',') AS fields").selectExpr(
        f"CAST(get(fields, 0) AS BIGINT) AS {KEY}", "get(fields, 3) AS terminal_text", "size(fields) AS field_count"
    )


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip")
    write_table(_cleaned(spark, sf_dir, strict=False), path)
    return _present(read_table(spark, path))


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by-day")
    dated = _cleaned(spark, sf_dir).selectExpr("*", "CAST(tx_datetime AS DATE) AS tx_date")
    write_table(dated, path, partition_by="tx_date")
    by_day = read_table(spark, path).groupBy(F.expr("CAST(tx_date AS STRING) AS tx_date"))
    return by_day.agg(F.expr("count(*) AS rows"), F.expr(f"sum({KEY}) AS key_sum"))


def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(decode_messages(encode_messages(load_transactions(spark, sf_dir))))


# ---- rules, profile, de-duplication


def clean_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(cleaning.apply_rules(load_transactions(spark, sf_dir), parity_rules()))


def clean_rules_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = strict_rules("2018-01-01", "2025-01-01")
    return _present(cleaning.apply_rules(load_transactions(spark, sf_dir), rules))


def clean_rules_open_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions moved by ten years: the default rules have no last day."""
    later = load_transactions(spark, sf_dir).withColumn("tx_datetime", F.expr("tx_datetime + INTERVAL '10' YEAR"))
    return _present(cleaning.apply_rules(later, strict_rules()))


def dedup_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(_cleaned(spark, sf_dir, strict=False))


def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: cleaned and de-duplicated transactions, counted by scenario."""
    by_scenario = _cleaned(spark, sf_dir, strict=False).groupBy("tx_fraud_scenario")
    return by_scenario.agg(
        F.expr("count(*) AS rows"), F.expr("sum(tx_fraud) AS frauds"), F.expr(f"sum({KEY}) AS key_sum")
    )


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.count_reject_reasons(load_transactions(spark, sf_dir), strict_rules())


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.with_reject_reasons(load_transactions(spark, sf_dir), strict_rules())
    return _present(rows.selectExpr(KEY, "tx_datetime", "array_join(reasons, ',') AS reasons"))


def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_missing(load_transactions(spark, sf_dir))


def profile_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_violations(load_transactions(spark, sf_dir))


def profile_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_domains(load_transactions(spark, sf_dir))


def profile_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_key_count(load_transactions(spark, sf_dir))


def feed_one_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report on the text feed, the malformed lines and the cleaned rows, from one parse of the text."""
    parsed = parse_once(spark, _feed_path(spark, sf_dir), strict_rules("2018-01-01", "2025-01-01"))
    reports = feed_reports(parsed)
    kept = cleaning.clean(parsed.rows, strict_rules("2018-01-01", "2025-01-01"))
    pairs = {
        "lines": reports["lines"].unpivot([], ["lines", "malformed"], "name", "rows"),
        "nans": reports["missing"].selectExpr("column AS name", "nans AS rows"),
        "nulls": reports["missing"].selectExpr("column AS name", "nulls AS rows"),
        "violations": reports["violations"].unpivot([], reports["violations"].columns, "name", "rows"),
        "reasons": reports["reject_reasons"].selectExpr("reason AS name", "rows"),
        "domains": reports["domains"].selectExpr("concat(column, '=', value) AS name", "rows"),
        "keys": reports["keys"].selectExpr("'distinct' AS name", "distinct_keys AS rows"),
        "malformed": parsed.malformed.selectExpr("concat('fields ', size(split(line, ','))) AS name").groupBy("name").agg(
            F.expr("count(*) AS rows")),
        "cleaned": kept.agg(F.expr("count(*) AS rows")).selectExpr("'rows' AS name", "rows"),
    }
    parts = [rows.selectExpr(f"'{report}' AS report", "name", "CAST(rows AS BIGINT) AS rows") for report, rows in pairs.items()]
    return reduce(DataFrame.union, parts)


def profile_key_count_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids by day, of all days and of a sketch of all rows: exact, and whether stored sketches are near enough.

    The sketches come from several files, batch by batch, so those of a day are put together from several.
    """
    rows, table, state = (load_transactions(spark, sf_dir), scratch_path(spark, "sketches"), scratch_path(spark, "sketch-state"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(_dealt(rows, "arriving", _as_parquet))
    run_batches(stream, state, lambda batch, number: merge_key_sketches(profile.daily_key_sketches(batch), table, state, number))
    stored = read_snapshot(spark, table, profile.daily_key_sketches(rows).schema)
    day = f"date_format({profile.DAY}, 'yyyy-MM-dd') AS day"
    by_day = profile.sketched_key_count(stored.withColumn("day", F.expr("date_format(day, 'yyyy-MM-dd')")), ["day"])
    exact_by_day = rows.groupBy(F.expr(day)).agg(
        F.expr("count(*) AS exact_rows"), F.expr(f"count(DISTINCT {KEY}) + max(CAST({KEY} IS NULL AS INT)) AS exact_keys"))
    whole = profile.sketched_key_count(stored).withColumnsRenamed({"rows": "all_rows", "distinct_keys": "all_keys"})
    near = f"abs({{}} - exact_keys) <= greatest(1D, {profile.relative_error()!r}D * exact_keys) AS near"
    days = exact_by_day.join(by_day.withColumnRenamed("day", "_day"), F.expr("day <=> _day")).selectExpr(
        "coalesce(day, 'none') AS scope", "rows", "exact_keys AS distinct_keys", near.format("distinct_keys"))
    exact = profile.profile_key_count(rows).selectExpr("1 AS one", "distinct_keys AS exact_keys")
    every = whole.selectExpr("1 AS one", "*").join(exact, "one").selectExpr(
        "'all' AS scope", "all_rows AS rows", "exact_keys AS distinct_keys", near.format("all_keys"))
    return days.union(every)


# ---- sampling, splitting, class balance


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(sampling.sample_rows(_cleaned(spark, sf_dir), 0.01, method=PORTABLE))


def sample_with_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(sampling.sample_with_replacement(_cleaned(spark, sf_dir), 0.01, method=PORTABLE))


def sample_first_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = sampling.split_rows(_cleaned(spark, sf_dir), (0.01, 0.95), salt="subset", method=PORTABLE)
    return _present(parts[0])


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = sampling.assign_split(_cleaned(spark, sf_dir), {"train": 0.8, "test": 0.2}, method=PORTABLE)
    return marked.select(KEY, "tx_fraud", "split")


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_counts(_cleaned(spark, sf_dir))


def oversample_minority(spark: SparkSession, sf_dir: str) -> DataFrame:
    balanced = sampling.oversample_minority(_staged_clean(spark, sf_dir), copy_column="copy")
    return balanced.select(KEY, "tx_fraud", "tx_amount", "copy")


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_weights(_staged_clean(spark, sf_dir)).select(KEY, "tx_fraud", WEIGHT)


# ---- features


def index_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _staged_clean(spark, sf_dir)
    indexed = scenario_indexer().fit(rows).transform(rows)
    return indexed.selectExpr(KEY, "tx_fraud_scenario", f"CAST({SCENARIO_INDEX} AS INT) AS {SCENARIO_INDEX}")


def onehot_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _staged_clean(spark, sf_dir)
    indexed = scenario_indexer().fit(rows).transform(rows)
    encoded = scenario_encoder().fit(indexed).transform(indexed)
    return vector_columns(encoded, SCENARIO_ONEHOT, "category_", 3).select(
        KEY, "tx_fraud_scenario", "category_0", "category_1", "category_2"
    )


def _feature_columns(df: DataFrame, vector: str) -> DataFrame:
    names = [f"x{i}" for i in range(FEATURE_COUNT)]
    return vector_columns(df, vector, "x", FEATURE_COUNT, DIGITS).select(KEY, *names)


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the parity rules, whose NaN amounts the assembly has to skip."""
    rows = _staged_clean(spark, sf_dir, strict=False)
    return _feature_columns(fit_features(rows, with_scenario=True).transform(rows), RAW_FEATURES)


def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _staged_clean(spark, sf_dir)
    assembled = VectorAssembler(inputCols=list(NUMERIC_FEATURES), outputCol=RAW_FEATURES).transform(rows)
    scaled = MinMaxScaler(inputCol=RAW_FEATURES, outputCol=FEATURES).fit(assembled).transform(assembled)
    names = [f"x{i}" for i in range(len(NUMERIC_FEATURES))]
    return vector_columns(scaled, FEATURES, "x", len(names), DIGITS).select(KEY, *names)


def feature_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the training part, applied to all rows."""
    rows = _staged_clean(spark, sf_dir)
    train = sampling.split_rows(rows, (0.8, 0.2), method=PORTABLE)[0]
    return _feature_columns(fit_features(train, with_scenario=True).transform(rows), FEATURES)


# ---- fit, tune, score


def train_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coefficient_rows(train_model(_staged_clean(spark, sf_dir)).model)


def train_known_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known order of steps: sample, oversample, features with scenario, then split."""
    options = known_model_options(fraction=1.0)
    return coefficient_rows(train_model(_staged_clean(spark, sf_dir), options).model)


def train_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(summary_rows(train_model(_staged_clean(spark, sf_dir)).model, "baseline"), round_all=True)


def tune_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = prepare(_staged_clean(spark, sf_dir), TrainOptions())
    return _present(tune(train, WEIGHT, parallelism=4).candidates, round_all=True)


# A fit has one result that any method finds: the least of its convex loss. These settings reach it.
CONVERGED = {"maxIter": 300, "regParam": 0.05, "elasticNetParam": 0.0, "tol": 1e-12}


def _converged(spark: SparkSession, sf_dir: str):
    """The weighted fit on the training part, carried to its end, with the rows of both parts."""
    train, test = prepare(_staged_clean(spark, sf_dir), TrainOptions(method=PORTABLE))
    return fit_scorer(train, WEIGHT, **CONVERGED), train, test


def train_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coefficient_rows(_converged(spark, sf_dir)[0]).selectExpr("term", "round(coefficient, 4) AS coefficient")


def train_converged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary's weighted accuracy, the areas over all training rows, and whether the summary's area is that one."""
    model, train, _ = _converged(spark, sf_dir)
    areas = evaluation.score_areas_exact(score_rows(train, model, keep=[LABEL]))
    told = summary_rows(model, "converged").groupBy("run").agg(
        F.expr("max(value) FILTER (WHERE metric = 'training_accuracy') AS accuracy"),
        F.expr("max(value) FILTER (WHERE metric = 'training_area_under_roc') AS summary_area"))
    return told.join(areas, F.lit(True)).selectExpr(
        "run", "round(accuracy, 5) AS accuracy", "round(area_under_roc, 5) AS area_under_roc",
        "round(area_under_pr, 4) AS area_under_pr", "abs(summary_area - area_under_roc) < 0.002 AS summary_agrees")


def train_converged_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and rates of the test rows by the fitted model, of each day."""
    model, _, test = _converged(spark, sf_dir)
    scored = score_rows(test, model, keep=[LABEL, "tx_time_days"])
    counts = evaluation.confusion_counts(scored, by=["tx_time_days"], unscored=True)
    return _present(evaluation.classification_metrics(counts), round_all=True)


def stream_score_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean score by day of the stream scored by the fitted, saved and loaded model."""
    path = scratch_path(spark, "stream-converged")
    save_model(_converged(spark, sf_dir)[0], path)
    by_day = _drained_scores(spark, sf_dir, load_model(path)).groupBy("tx_time_days")
    return by_day.agg(F.expr("count(*) AS rows"), F.expr("round(avg(score), 4) AS mean_score"))


# Fixed: 18 weight vectors, two kinds of amounts by three of seconds by three of days.
GRID_VECTORS = [([amount, seconds, days], -1.0) for amount in (3.0, -0.5) for seconds in (0.0, 0.25, -1.0) for days in (0.0, 0.5, -2.0)]


def grid_areas_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of 18 linear models on the scaled features, from one scan."""
    rows = _staged_clean(spark, sf_dir)
    return _present(grid_areas(fit_features(rows).transform(rows), GRID_VECTORS), round_all=True)


def tune_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid's points, the sizes of the two sides, and what must hold of every fit and of the choice.

    A fit without an intercept has none, and the point that was chosen has the largest of the areas.
    """
    train, _ = prepare(_staged_clean(spark, sf_dir), TrainOptions(method=PORTABLE))
    tuned = tune(train, WEIGHT, parallelism=4, keep_sub_models=True, method=PORTABLE)
    intercepts = [(at, float(model.intercept)) for at, model in enumerate(tuned.sub_models)]
    fits = spark.createDataFrame(intercepts, "at INT, intercept DOUBLE")
    sides = train.selectExpr(f"{unit_uniform('tune-7', KEY, method=PORTABLE)} < {TRAIN_RATIO!r}D AS fitted", LABEL).agg(
        F.expr("count_if(fitted) AS fit_rows"), F.expr("count_if(NOT fitted) AS validation_rows"),
        F.expr(f"count_if(NOT fitted AND {LABEL} = 1) AS validation_fraud"))
    best = "max(area_under_pr) OVER ()"
    return tuned.candidates.join(fits, F.expr("at = candidate")).join(sides, F.lit(True)).selectExpr(
        "reg_param", "fit_intercept", "elastic_net", "fit_rows", "validation_rows", "validation_fraud",
        "fit_intercept OR intercept = 0 AS intercept_kept", f"NOT is_best OR area_under_pr = {best} AS best_is_largest",
        "count_if(is_best) OVER () AS chosen")


def model_reload_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the fitted model and by its saved and reloaded copy."""
    trained = train_model(_staged_clean(spark, sf_dir), TrainOptions(method=PORTABLE))
    path = scratch_path(spark, "model")
    save_model(trained.model, path)
    first = score_rows(trained.test, trained.model).withColumnsRenamed({"score": "score_0", "prediction": "label_0"})
    both = score_rows(first, load_model(path))
    return both.selectExpr(KEY, "tx_fraud", "score = score_0 AND prediction = label_0 AS same_result")


def score_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir).select("model", KEY, "tx_fraud", "score", "prediction")
    return _present(scored, round_all=True)


def score_missing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions cleaned by the parity rules, some without an amount: each gets a row."""
    return _present(score_rows(_cleaned(spark, sf_dir, strict=False), CANDIDATE, keep=[KEY, "tx_fraud"]), round_all=True)


# ---- evaluation


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confusion(spark, sf_dir)


def confusion_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions cleaned by the parity rules, some without an amount: cells, unscored rows and rates."""
    scored = score_rows(_cleaned(spark, sf_dir, strict=False), CANDIDATE, keep=[LABEL])
    counts = evaluation.confusion_counts(scored, unscored=True)
    return _present(evaluation.error_rates(evaluation.classification_metrics(counts)), round_all=True)


def label_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second pair of 0/1 columns: ``toxic`` judged by low ``quality``."""
    labels = read_table(spark, f"{sf_dir}/labels.parquet").selectExpr("toxic", "1 - quality AS guess")
    counts = evaluation.confusion_counts(labels, label="toxic", prediction="guess")
    return _present(evaluation.hard_areas(evaluation.classification_metrics(counts)), round_all=True)


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(evaluation.classification_metrics(_confusion(spark, sf_dir)), round_all=True)


def classification_metrics_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(evaluation.swapped_metrics(_confusion(spark, sf_dir)), round_all=True)


def hard_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = evaluation.hard_areas(_confusion(spark, sf_dir))
    return _present(areas.select("model", "area_under_roc", "area_under_pr"), round_all=True)


def score_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(evaluation.score_areas(_scored(spark, sf_dir), by=["model"]), round_all=True)


def score_curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curves themselves: a point for each score (to six digits) of each model."""
    scored = _scored(spark, sf_dir).selectExpr("model", LABEL, f"round(score, {DIGITS}) AS score")
    points = evaluation.curve_rates(evaluation.score_curve(scored, by=["model"]), by=["model"])
    return _present(points, round_all=True)


def prepared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test tables bucketed by transaction, joined with scores bucketed alike, no row shuffled."""
    cleaned, name, path = _staged_clean(spark, sf_dir), f"prepared_{uuid.uuid4().hex}", scratch_path(spark, "prepared")
    parts = prepare_tables(cleaned, name, TrainOptions(method=PORTABLE), PREPARED_BUCKETS, path)
    scores = score_rows(cleaned, CANDIDATE, keep=[KEY])
    scores = write_bucketed(scores, f"{name}_scores", KEY, PREPARED_BUCKETS, f"{path}/scores")
    joined = [
        cleaning.deduplicate(rows.select(*COLUMNS)).join(scores, KEY).groupBy(F.lit(part).alias("split"), LABEL).agg(
            F.expr("count(*) AS rows"), F.expr(f"sum({KEY}) AS key_sum"), F.expr("count_if(prediction = 1) AS flagged"))
        for part, rows in zip(("train", "test"), parts)
    ]
    return joined[0].union(joined[1])


def snapshot_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot table that one cleaning job writes and another one, with other rules, writes anew."""
    feed, table = _feed_path(spark, sf_dir), scratch_path(spark, "snapshot")
    clean_feed(spark, feed, table, strict=False, snapshot=True)
    return _present(clean_feed(spark, feed, table, days=("2018-01-01", "2025-01-01"), snapshot=True))


def score_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(evaluation.score_areas_exact(_scored(spark, sf_dir), by=["model"]), round_all=True)


def _bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.bootstrap_counts(_scored(spark, sf_dir), method=PORTABLE)


def bootstrap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bootstrap(spark, sf_dir)


def bootstrap_aupr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(comparison.sample_scores(_bootstrap(spark, sf_dir)), round_all=True)


def bootstrap_aupr_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(comparison.sample_scores(_bootstrap(spark, sf_dir), swapped=True), round_all=True)


def bootstrap_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = comparison.bootstrap_counts_by_cell(_scored(spark, sf_dir))
    return _present(comparison.sample_scores(counts), round_all=True)


def bootstrap_by_cell_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each cell its rows, the samples, and whether the draws of all samples lie within six deviations of their mean."""
    scored = _scored(spark, sf_dir)
    drawn = comparison.bootstrap_counts_by_cell(scored)
    cells = ", ".join(f"'{cell}', {cell}" for cell in evaluation.CELLS)
    totals = drawn.selectExpr("model", "replicate", f"stack(4, {cells}) AS (cell, drawn)").groupBy("model", "cell").agg(
        F.expr("count(DISTINCT replicate) AS samples"), F.expr("sum(drawn) AS drawn"))
    held = evaluation.confusion_counts(scored, by=["model"]).selectExpr("model", f"stack(4, {cells}) AS (cell, rows)")
    mean = f"rows * {comparison.REPLICATES * comparison.FRACTION!r}D"
    return held.join(totals, ["model", "cell"]).selectExpr(
        "model", "cell", "rows", "samples", f"abs(drawn - {mean}) <= 6 * sqrt({mean}) AS within_bounds")


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparison.score_histogram(comparison.sample_scores(_bootstrap(spark, sf_dir)))


def score_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = comparison.sample_scores(_bootstrap(spark, sf_dir))
    return _present(comparison.score_intervals(scores), round_all=True)


def _test_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = comparison.sample_scores(_bootstrap(spark, sf_dir))
    return comparison.compare_models(scores, "baseline", "candidate")


def ab_ttest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(_test_result(spark, sf_dir), round_all=True)


def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(comparison.promotion_gate(_test_result(spark, sf_dir)), round_all=True)


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows appended to a table and read back."""
    path = scratch_path(spark, "metrics")
    metrics = evaluation.classification_metrics(_confusion(spark, sf_dir))
    write_table(evaluation.metrics_long(metrics, "model"), path, mode="append")
    return _present(read_table(spark, path), round_all=True)


def kpi_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(evaluation.error_rates(_confusion(spark, sf_dir)), round_all=True)


def monthly_missed_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _present(evaluation.monthly_missed_loss(_scored(spark, sf_dir), by=["model"]), round_all=True)


def validate_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole validation job on fitted models: decision row."""
    return _present(validate(_staged_clean(spark, sf_dir), parallelism=4).decision, round_all=True)


# ---- streams


FILES = 3  # files into which a table is dealt where a stream shall have several batches
PREPARED_BUCKETS = 8
STREAM_BLOCK = 20_000  # ids in a block of a merged table of the catalog


def _dealt(rows: DataFrame, label: str, write: Callable[[DataFrame, str], None]) -> str:
    """Rows as several files, copies of a transaction in different ones, the later copy first for many."""
    path = scratch_path(rows.sparkSession, label)
    write(rows.repartition(FILES), path)
    return path


def _as_parquet(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that arrive in several files, merged batch by batch."""
    table, state = scratch_path(spark, "clean-stream"), scratch_path(spark, "clean-stream-state")
    rows = load_transactions(spark, sf_dir)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(_dealt(rows, "arriving", _as_parquet))
    run_batches(stream, state, lambda batch, number: merge_transactions(batch, table, state, number, block_ids=STREAM_BLOCK))
    return _present(read_snapshot(spark, table, rows.schema))


def stream_clean_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental cleaning of the text feed, a file at a time."""
    feed = _dealt(feed_lines(load_transactions(spark, sf_dir)), "feed", write_feed_lines)
    return _present(merge_new_files(spark, feed, scratch_path(spark, "clean-feed"), scratch_path(spark, "clean-feed-state"),
                                    wide_ids=True, block_ids=STREAM_BLOCK, files_per_batch=1))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of several files, some cut short: scored, rejected and repeated ones, which add up to the input."""
    state, sink, rejects = (scratch_path(spark, label) for label in ("routed-state", "routed", "routed-rejects"))
    cut = f"IF({KEY} % 103 = 0, left(value, 40), value) AS value"
    messages = encode_messages(load_transactions(spark, sf_dir)).selectExpr("key", f"CAST(key AS BIGINT) AS {KEY}", "value")
    source = _dealt(messages.selectExpr("key", cut), "messages", _as_parquet)
    start_routed(spark, CANDIDATE, "parquet", "parquet", state, rejects, source, sink, {"maxFilesPerTrigger": "1"},
                 enveloped=True, block_ids=STREAM_BLOCK).awaitTermination()
    number = f"CAST(regexp_extract(line, '.transaction_id.:([0-9]+)', 1) AS BIGINT) AS {KEY}"
    scored = spark.read.parquet(sink).selectExpr("'scored' AS outcome", KEY, "CAST(NULL AS STRING) AS reasons", "1L AS rows")
    failed = spark.read.parquet(rejects).selectExpr("'rejected' AS outcome", number, "array_join(reasons, ',') AS reasons", "1L AS rows")
    copies = spark.read.parquet(f"{rejects}-copies").selectExpr("'copy' AS outcome", KEY, "NULL AS reasons", "copies AS rows")
    every = scored.union(failed).union(copies)
    return every.groupBy("outcome", KEY, "reasons").agg(F.sum("rows").alias("rows"))


def _drained_scores(spark: SparkSession, sf_dir: str, model) -> DataFrame:
    rows = score_rows(clean_stream(stream_transactions(spark, sf_dir)), model, keep=COLUMNS)
    return drain_to_files(rows, scratch_path(spark, "scored"), scratch_path(spark, "scored-state"))


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _drained_scores(spark, sf_dir, CANDIDATE).select(KEY, "tx_fraud", "score", "prediction")
    return _present(scored, round_all=True)


def stream_score_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream scored by a fitted model that was saved and loaded."""
    path = scratch_path(spark, "stream-model")
    save_model(fit_scorer(_staged_clean(spark, sf_dir), regParam=0.01, maxIter=20), path)
    scored = _drained_scores(spark, sf_dir, load_model(path)).select(KEY, "tx_fraud", "score", "prediction")
    return _present(scored, round_all=True)


def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics of scored rows that arrive in several files, days mixed, each file read once."""
    scored = score_rows(_cleaned(spark, sf_dir), CANDIDATE)
    path = _dealt(scored, "scored-table", _as_parquet)
    found = monitor(spark, path, scratch_path(spark, "windows"), scratch_path(spark, "windows-state"), files_per_batch=1)
    return _present(found, round_all=True)


def window_metrics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same metrics of a table, in which no window is open."""
    return _present(window_metrics(score_rows(_cleaned(spark, sf_dir), CANDIDATE)), round_all=True)


_QUERIES: tuple[Query, ...] = (
    clean_counts, csv_scan, csv_rejects, parquet_roundtrip, partitioned_roundtrip, message_roundtrip,
    clean_rules, clean_rules_strict, clean_rules_open_end, dedup_transactions, reject_reasons, rejected_rows,
    profile_nulls, profile_violations, profile_domains, profile_key_count,
    feed_one_parse, profile_key_count_sketched, score_curve_points, prepared_tables, snapshot_rewrite,
    sample_rows, sample_with_replacement, sample_first_part, train_test_split, class_counts, oversample_minority, class_weights,
    index_scenario, onehot_scenario, assemble_features, minmax_scale, feature_pipeline,
    train_baseline, train_known_model, train_summary, train_converged, train_converged_summary, train_converged_holdout,
    grid_areas_fixed, tune_grid, tune_candidate, confusion_unscored, bootstrap_by_cell_bounds, stream_score_converged, model_reload_score, score_transactions, score_missing_features,
    confusion_matrix, label_confusion, classification_metrics, classification_metrics_swapped, hard_auc,
    score_auc, score_auc_exact, bootstrap_counts, bootstrap_aupr, bootstrap_aupr_swapped, bootstrap_by_cell,
    score_histogram, score_interval, ab_ttest, promotion_gate, metrics_long, kpi_error_rates,
    monthly_missed_loss, validate_models, stream_clean, stream_clean_feed, stream_rejects, stream_score, stream_score_model, stream_window_metrics,
    window_metrics_all,
)


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {query.__name__: _in_utc(query) for query in _QUERIES}
