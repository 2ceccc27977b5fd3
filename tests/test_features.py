from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardloom.operators.features import (
    FEATURES, RAW_FEATURES, fit_features, scenario_encoder, scenario_indexer, vector_columns, vector_size,
)


def test_index_order_is_frequency_then_text(make_transactions):
    rows = make_transactions(*[{"tx_fraud_scenario": s} for s in (3, 3, 2, 1, 1, 0)])
    model = scenario_indexer().fit(rows)
    assert model.labels == ["1", "3", "0", "2"]


def test_last_category_is_all_zeros(make_transactions):
    rows = make_transactions(*[{"tx_fraud_scenario": s} for s in (0, 0, 0, 1, 1, 2)])
    indexed = scenario_indexer().fit(rows).transform(rows)
    encoded = scenario_encoder().fit(indexed).transform(indexed)
    got = {r.tx_fraud_scenario: list(r.v) for r in encoded.select(
        "tx_fraud_scenario", vector_to_array("scenario_onehot").alias("v")).collect()}
    assert got == {0: [1.0, 0.0], 1: [0.0, 1.0], 2: [0.0, 0.0]}


def test_missing_and_nan_features_are_skipped(make_transactions):
    rows = make_transactions({"transaction_id": 1}, {"transaction_id": 2, "tx_amount": None},
                             {"transaction_id": 3, "tx_amount": float("nan")})
    assert [r.transaction_id for r in fit_features(rows).transform(rows).collect()] == [1]


def test_scaling_uses_the_training_range_and_halves_constants(make_transactions):
    train = make_transactions({"tx_amount": 10.0, "tx_time_seconds": 5}, {"tx_amount": 20.0, "tx_time_seconds": 5})
    model = fit_features(train)
    other = make_transactions({"tx_amount": 25.0, "tx_time_seconds": 5})
    row = vector_columns(model.transform(other), FEATURES, "x", 4).first()
    assert (row.x0, row.x1, row.x2) == (1.5, 0.5, 0.5)
    assert row.x3 is None  # no such entry


def test_unseen_category(make_transactions):
    train = make_transactions({"tx_fraud_scenario": 0}, {"tx_fraud_scenario": 1})
    other = make_transactions({"tx_fraud_scenario": 3})
    with pytest.raises(Exception, match="Unseen label"):
        fit_features(train, with_scenario=True).transform(other).collect()
    kept = fit_features(train, with_scenario=True, on_unseen="keep").transform(other)
    assert kept.count() == 1


def test_scenario_is_left_out_by_default(make_transactions):
    rows = make_transactions({"tx_fraud_scenario": 0}, {"tx_fraud_scenario": 1}, {"tx_fraud_scenario": 2})
    for with_scenario, size in ((False, 3), (True, 5)):
        row = fit_features(rows, with_scenario).transform(rows).select(RAW_FEATURES).first()
        assert row[0].size == size


def test_a_vector_is_never_cut(spark, make_transactions):
    from pyspark.ml.functions import array_to_vector

    rows = make_transactions({"tx_amount": 10.0}, {"tx_amount": 20.0})
    made = fit_features(rows).transform(rows)
    assert vector_size(made, FEATURES) == 3
    assert [c for c in vector_columns(made, FEATURES, "x").columns if c.startswith("x")] == ["x0", "x1", "x2"]
    with pytest.raises(ValueError, match="3 entries"):
        vector_columns(made, FEATURES, "x", 2)
    unknown = spark.range(2).select("id", array_to_vector(F.expr("array_repeat(1D, CAST(id AS INT) + 1)")).alias("v"))
    with pytest.raises(ValueError, match="not known"):
        vector_columns(unknown, "v", "x")
    assert [r.x1 for r in vector_columns(unknown, "v", "x", 2).orderBy("id").collect()] == [None, 1.0]
    with pytest.raises(Exception, match="2 entries"):
        vector_columns(unknown, "v", "x", 1).collect()
