"""Feature chain: category index, one-hot, assembly, min-max scaling."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from cardloom.schema import SCENARIO

# The numeric features, in vector order.
NUMERIC_FEATURES = ("tx_amount", "tx_time_seconds", "tx_time_days")

SCENARIO_INDEX = "scenario_index"
SCENARIO_ONEHOT = "scenario_onehot"
RAW_FEATURES = "raw_features"
FEATURES = "features"


def scenario_indexer(on_unseen: str = "error") -> StringIndexer:
    """Scenario to index by falling frequency, ties in alphabetical order."""
    return StringIndexer(inputCol=SCENARIO, outputCol=SCENARIO_INDEX, handleInvalid=on_unseen)


def scenario_encoder() -> OneHotEncoder:
    """One-hot vector of the index; the last category is all zeros."""
    return OneHotEncoder(inputCols=[SCENARIO_INDEX], outputCols=[SCENARIO_ONEHOT])


def feature_stages(with_scenario: bool = False, on_unseen: str = "error") -> list:
    """Stages from raw columns to ``features``.

    ``with_scenario`` adds the scenario as a feature. It names the kind of fraud and thus
    gives the label away, so it is off unless a known result has to be repeated. Rows with
    a missing or NaN feature are skipped.
    """
    stages: list = [scenario_indexer(on_unseen), scenario_encoder()] if with_scenario else []
    inputs = [*NUMERIC_FEATURES, *([SCENARIO_ONEHOT] if with_scenario else [])]
    assembler = VectorAssembler(inputCols=inputs, outputCol=RAW_FEATURES, handleInvalid="skip")
    scaler = MinMaxScaler(inputCol=RAW_FEATURES, outputCol=FEATURES)
    return [*stages, assembler, scaler]


def fit_features(train: DataFrame, with_scenario: bool = False, on_unseen: str = "error") -> PipelineModel:
    """Fit the chain. Fit it on training rows only, then apply it to the others."""
    return Pipeline(stages=feature_stages(with_scenario, on_unseen)).fit(train)


def vector_size(df: DataFrame, vector: str) -> int | None:
    """Number of entries of a vector column, if the stage that made it says so."""
    return df.schema[vector].metadata.get("ml_attr", {}).get("num_attrs")


def vector_columns(df: DataFrame, vector: str, prefix: str, size: int | None = None, digits: int | None = None) -> DataFrame:
    """Spread a vector over columns ``<prefix>0``, ``<prefix>1``, ... to ``size``, by default the vector's own size.

    A vector with more entries is an error, at once if the column's metadata has the size, else when
    such a row is met; entries beyond a shorter vector, and those of a NULL vector, are NULL.
    """
    known = vector_size(df, vector)
    if size is None and known is None:
        raise ValueError(f"the size of {vector} is not known: name it")
    if size is not None and known is not None and known > size:
        raise ValueError(f"{vector} has {known} entries, more than {size}")
    size = known if size is None else size
    spread = df.withColumn("_values", vector_to_array(vector))
    long = f"raise_error(concat('a vector has ', size(_values), ' entries, more than {size}'))"
    entries = [f"IF(size(_values) > {size}, {long}, get(_values, {i}))" if known is None else f"get(_values, {i})"
               for i in range(size)]
    if digits is not None:
        entries = [f"round({entry}, {digits})" for entry in entries]
    return spread.selectExpr(*df.columns, *[f"{entry} AS {prefix}{i}" for i, entry in enumerate(entries)])
