from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardloom.schema import transactions_schema  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def make_transactions(spark):
    """Transactions from partial dicts; the other columns get harmless values."""
    from datetime import datetime

    base = {
        "transaction_id": 1, "tx_datetime": datetime(2024, 1, 1), "customer_id": 1, "terminal_id": 1,
        "tx_amount": 10.0, "tx_time_seconds": 0, "tx_time_days": 0, "tx_fraud": 0, "tx_fraud_scenario": 0,
    }

    def make(*rows: dict):
        filled = [tuple({**base, **row}.values()) for row in rows]
        return spark.createDataFrame(filled, transactions_schema(wide_ids=True))

    return make
