"""Transactions derived from the ``events`` table, with defects and duplicates.

``events`` is clean, so the rules, the profile and the de-duplication would have nothing
to do on it. Defects are functions of the ids, so every engine derives the same rows, and
their number grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardloom.schema import COLUMNS

# 2024-01-01T00:00:00Z, the first day of the events, in seconds.
EPOCH_START = 1704067200


def transactions_from_events(events: DataFrame) -> DataFrame:
    """One transaction per event, and a copy one day later for every tenth id.

    Works on batch and streaming frames. The copies come from ``explode`` rather than a
    union, so the events are scanned once.
    """
    prepared = events.selectExpr(
        "event_id", "user_id", "value", "CAST(ts AS TIMESTAMP) AS ts",
        "CASE WHEN value > 150 THEN 1 WHEN event_id % 37 = 0 THEN 2 WHEN user_id % 29 = 0 THEN 3 ELSE 0 END"
        " AS scenario",
        f"unix_seconds(CAST(ts AS TIMESTAMP)) - {EPOCH_START} AS seconds",
        "explode(if(event_id % 10 = 0, array(0, 1), array(0))) AS copy",
    )
    return prepared.selectExpr(
        "event_id AS transaction_id",
        "CASE WHEN event_id % 71 = 0 THEN NULL ELSE ts + make_dt_interval(copy) END AS tx_datetime",
        "if(event_id % 53 = 0, -1L, user_id) AS customer_id",
        "event_id % 1000 AS terminal_id",
        "CASE WHEN event_id % 41 = 0 THEN -value WHEN event_id % 89 = 0 THEN double('NaN') ELSE value END"
        " AS tx_amount",
        "CAST(seconds AS INT) AS tx_time_seconds",
        "CAST(floor(seconds / 86400) AS INT) AS tx_time_days",
        "CASE WHEN event_id % 67 = 0 THEN 2 WHEN scenario > 0 THEN 1 ELSE 0 END AS tx_fraud",
        "if(event_id % 61 = 0, 7, scenario) AS tx_fraud_scenario",
    )


def events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(spark.read.parquet(events_path(sf_dir)))


def stream_transactions(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The same rows as a stream over the files of the ``events`` table.

    The pattern matches just that table; a plain path would have to be a folder, while the
    table may also be a single file.
    """
    reader = spark.readStream.schema(spark.read.parquet(events_path(sf_dir)).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return transactions_from_events(reader.parquet(f"{sf_dir}/event[s].parquet"))


def feed_lines(transactions: DataFrame) -> DataFrame:
    """Transactions as feed text, with comment lines and malformed lines among them.

    The malformed kinds are the ones a feed shows: text in a number, a month 13, a line cut
    short and a line with a field too many.
    """
    fields = {name: f"coalesce(CAST({name} AS STRING), '')" for name in COLUMNS}
    fields["tx_datetime"] = (
        "CASE WHEN transaction_id % 103 = 0 THEN '2024-13-01 00:00:00' "
        "ELSE coalesce(date_format(tx_datetime, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), '') END"
    )
    fields["terminal_id"] = f"if(transaction_id % 97 = 0, 'Err', {fields['terminal_id']})"
    texts = list(fields.values())
    body = (
        f"CASE WHEN transaction_id % 101 = 0 THEN concat_ws(',', {', '.join(texts[:5])}) "
        f"WHEN transaction_id % 107 = 0 THEN concat_ws(',', {', '.join(texts)}, '99') "
        f"ELSE concat_ws(',', {', '.join(texts)}) END"
    )
    lines = transactions.selectExpr("transaction_id", f"{body} AS body")
    comment = "concat('# before ', transaction_id)"
    return lines.selectExpr(f"explode(if(transaction_id % 109 = 0, array({comment}, body), array(body))) AS value")
