"""The transactions table: one wide, flat table whose columns are all nullable."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _DOUBLE, _TIME = T.IntegerType(), T.DoubleType(), T.TimestampType()

# Column names and types of the transactions feed, in file order.
FIELD_TYPES = {
    "transaction_id": _INT,
    "tx_datetime": _TIME,
    "customer_id": _INT,
    "terminal_id": _INT,
    "tx_amount": _DOUBLE,
    "tx_time_seconds": _INT,
    "tx_time_days": _INT,
    "tx_fraud": _INT,
    "tx_fraud_scenario": _INT,
}

COLUMNS = tuple(FIELD_TYPES)
KEY = "transaction_id"
EVENT_TIME = "tx_datetime"
AMOUNT = "tx_amount"
LABEL = "tx_fraud"
SCENARIO = "tx_fraud_scenario"
ID_COLUMNS = (KEY, "customer_id", "terminal_id")


def transactions_schema(wide_ids: bool = True) -> T.StructType:
    """Schema of the transactions table.

    The three id columns are BIGINT, or INT without ``wide_ids``; an id beyond 2^31 is then malformed.
    """
    schema = T.StructType()
    for name, data_type in FIELD_TYPES.items():
        schema.add(name, T.LongType() if wide_ids and name in ID_COLUMNS else data_type)
    return schema
