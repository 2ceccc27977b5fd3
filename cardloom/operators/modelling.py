"""Fit, tune, save and apply the fraud classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.functions.hashing import unit_uniform
from cardloom.functions.scoring import LinearModel
from cardloom.operators.evaluation import score_areas
from cardloom.operators.features import FEATURES, NUMERIC_FEATURES, feature_stages, fit_features
from cardloom.schema import KEY, LABEL
from cardloom.sources.tables import stage

# The baseline model and the search grid.
BASELINE_PARAMS = {"maxIter": 1, "regParam": 0.2, "elasticNetParam": 0.8}
GRID_REG_PARAM = [0.05, 0.1, 0.5]
GRID_FIT_INTERCEPT = [False, True]
GRID_ELASTIC_NET = [0.0, 0.5, 1.0]
TRAIN_RATIO = 0.75

GRID_BINS = 16_384  # steps of a candidate's curve while tuning


class Tuned(NamedTuple):
    model: PipelineModel
    candidates: DataFrame
    sub_models: list[LogisticRegressionModel] | None


def classifier(weight: str | None = None, **params) -> LogisticRegression:
    """Binomial logistic regression with the baseline settings, unless overridden."""
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, family="binomial", **{**BASELINE_PARAMS, **params})
    return lr.setWeightCol(weight) if weight else lr


def fit_scorer(train: DataFrame, weight: str | None = None, with_scenario: bool = False,
               on_unseen: str = "error", **params) -> PipelineModel:
    """Fit features and classifier as one model, so the saved artefact scores raw rows."""
    stages = [*feature_stages(with_scenario, on_unseen), classifier(weight, **params)]
    return Pipeline(stages=stages).fit(train)


def last_stage(model: PipelineModel) -> LogisticRegressionModel:
    return model.stages[-1]


def term_names(model: PipelineModel) -> list[str]:
    """Names of the coefficients: numeric features, then the encoded categories."""
    encoded = last_stage(model).numFeatures - len(NUMERIC_FEATURES)
    labels = model.stages[0].labels if encoded else []
    return [*NUMERIC_FEATURES, *[f"scenario_{label}" for label in labels[:encoded]]]


def coefficient_rows(model: PipelineModel) -> DataFrame:
    """Coefficients and intercept as ``(term, coefficient)``."""
    lr = last_stage(model)
    rows = [*zip(term_names(model), map(float, lr.coefficients)), ("intercept", float(lr.intercept))]
    return SparkSession.active().createDataFrame(rows, "term STRING, coefficient DOUBLE")


def summary_rows(model: PipelineModel, run: str) -> DataFrame:
    """Accuracy and area under ROC on the training rows as ``(run, metric, value)``."""
    summary = last_stage(model).summary
    rows = [(run, "training_accuracy", summary.accuracy), (run, "training_area_under_roc", summary.areaUnderROC)]
    return SparkSession.active().createDataFrame(rows, "run STRING, metric STRING, value DOUBLE")


def param_rows(model: PipelineModel, run: str) -> DataFrame:
    """Parameters of the classifier as ``(run, param, value)``."""
    rows = [(run, p.name, str(v)) for p, v in last_stage(model).extractParamMap().items()]
    return SparkSession.active().createDataFrame(rows, "run STRING, param STRING, value STRING")


def fraud_probability() -> Column:
    """Probability of class 1 from the classifier's output vector."""
    return F.get(vector_to_array("probability"), F.lit(1))


def score_rows(rows: DataFrame, model: PipelineModel | LinearModel, keep: Sequence[str] = ()) -> DataFrame:
    """Apply a model to a table or a stream: the columns to keep plus ``score`` and ``prediction``.

    Every row comes back. One with a missing feature, NULL or NaN, has neither score nor prediction.
    """
    keep = list(keep or rows.columns)
    if isinstance(model, LinearModel):
        return rows.selectExpr(
            *keep, f"nullif({model.score()}, double('NaN')) AS score",
            f"CASE WHEN NOT isnan({model.margin()}) THEN {model.prediction()} END AS prediction")
    scored = _keeping_all_rows(model).transform(rows).select(*keep, fraud_probability().alias("score"), "prediction")
    return scored.selectExpr(
        *keep, "CASE WHEN NOT isnan(score) THEN score END AS score",
        "CASE WHEN NOT isnan(score) THEN prediction END AS prediction")


def _keeping_all_rows(model: PipelineModel) -> PipelineModel:
    """The same model, whose assemblers pass rows with missing features on instead of skipping them."""
    def keeping(step):
        if isinstance(step, PipelineModel):
            return _keeping_all_rows(step)
        return step.copy({step.handleInvalid: "keep"}) if isinstance(step, VectorAssembler) else step

    return PipelineModel([keeping(step) for step in model.stages])


def score_with_all(rows: DataFrame, models: Mapping[str, PipelineModel | LinearModel],
                   keep: Sequence[str] = (KEY, LABEL)) -> DataFrame:
    """Scores of several models in long form, ``(keep..., model, score, prediction)``, from one scan."""
    scored, structs = rows, []
    for i, (name, model) in enumerate(models.items()):
        scored = score_rows(scored, model).withColumnsRenamed({"score": f"_score{i}", "prediction": f"_prediction{i}"})
        structs.append(f"named_struct('model', '{name}', 'score', _score{i}, 'prediction', _prediction{i})")
    return scored.selectExpr(*keep, f"inline(array({', '.join(structs)}))")


def grid_areas(rows: DataFrame, candidates: Sequence[tuple[Sequence[float], float]], features: str = FEATURES,
               label: str = LABEL, bins: int = GRID_BINS) -> DataFrame:
    """``(candidate, area_under_roc, area_under_pr)`` of many linear models, from one scan of ``rows``.

    A candidate is its coefficients and its intercept; it is named by its position. Features lie
    between 0 and 1, as the feature chain leaves those it was fitted on, so the least and the
    greatest margin of a candidate are known beforehand. Margins are counted in ``bins`` equal steps
    between them, one aggregate for all candidates; at most ``bins`` rows a candidate are sorted. A
    row without a vector or with a NaN feature is left out. An empty table has no areas.
    """
    places = []
    for at, (coefficients, intercept) in enumerate(candidates):
        low = sum(min(c, 0.0) for c in coefficients)
        width = sum(abs(c) for c in coefficients) or 1.0
        terms = " + ".join(f"{float(c)!r}D * get(_values, {i})" for i, c in enumerate(coefficients) if c) or "0D"
        # The intercept moves all margins of a candidate alike, so it has no place in the order.
        places.append(f"named_struct('candidate', {at}, 'place', ({terms} - {float(low)!r}D) / {float(width)!r}D)")
    spread = rows.select(label, vector_to_array(features).alias("_values"))
    complete = spread.where("_values IS NOT NULL AND NOT exists(_values, v -> isnan(v))")
    placed = complete.selectExpr(label, f"inline(array({', '.join(places)}))")
    return score_areas(placed, by=["candidate"], score="place", label=label, bins=bins)


def tune(train: DataFrame, weight: str | None = None, with_scenario: bool = False, on_unseen: str = "error",
         parallelism: int = 2, seed: int = 7, base: LogisticRegression | None = None,
         keep_sub_models: bool = False, method: str = "xxhash64") -> Tuned:
    """Search the grid on one train/validation split by area under the precision-recall curve.

    The split is by a hash of the transaction, so it does not depend on partitions, and copies of
    a row stay on one side. The fits are weighted; the area counts each validation row once.
    The features are fitted and applied once, and only label, weight, vector and side are
    staged; every fit then reads that narrow table, and one scan of the validation side gives the
    areas of all candidates. The best point, of equals the first, is fitted again on all rows.
    The models that lose are dropped unless asked for.
    """
    features = fit_features(train, with_scenario, on_unseen)
    columns = [LABEL, FEATURES, *([weight] if weight else [])]
    side = f"{unit_uniform(f'tune-{seed}', KEY, method=method)} < {TRAIN_RATIO!r}D AS _fit"
    prepared = stage(features.transform(train).selectExpr(*columns, side), "tuning")
    lr = base or classifier(weight)
    grid = (
        ParamGridBuilder()
        .addGrid(lr.regParam, GRID_REG_PARAM)
        .addGrid(lr.fitIntercept, GRID_FIT_INTERCEPT)
        .addGrid(lr.elasticNetParam, GRID_ELASTIC_NET)
        .build()
    )
    fits, kept = prepared.where("_fit"), prepared.where("NOT _fit")
    models: list = [None] * len(grid)
    todo = lr.fitMultiple(fits, grid)
    with ThreadPool(min(parallelism, len(grid))) as pool:  # each thread takes the next point and fits it
        for at, model in pool.imap_unordered(lambda _: next(todo), range(len(grid))):
            models[at] = model
    areas = [0.0] * len(grid)
    linear = [(list(map(float, model.coefficients)), float(model.intercept)) for model in models]
    for row in grid_areas(kept, linear).collect():  # a row per candidate
        areas[row.candidate] = row.area_under_pr or 0.0  # none without fraud on this side
    best = max(range(len(grid)), key=areas.__getitem__)
    rows = [
        (i, point[lr.regParam], point[lr.fitIntercept], point[lr.elasticNetParam],
         float(areas[i]), i == best)
        for i, point in enumerate(grid)
    ]
    candidates = train.sparkSession.createDataFrame(
        rows, "candidate INT, reg_param DOUBLE, fit_intercept BOOLEAN, elastic_net DOUBLE, "
              "area_under_pr DOUBLE, is_best BOOLEAN",
    )
    chosen = lr.copy(grid[best]).fit(prepared)
    return Tuned(PipelineModel([*features.stages, chosen]), candidates, models if keep_sub_models else None)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
