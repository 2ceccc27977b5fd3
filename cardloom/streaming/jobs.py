"""Incremental cleaning and windowed monitoring; scoring is the same as for tables.

Each step reads one stream and writes another, so they can be run and restarted on their
own: feed -> clean transactions -> scored transactions -> window metrics. The ``merge_`` functions enter
batches in tables that further rows correct; ``clean_stream`` and ``window_metrics`` append to sinks that
cannot be corrected, within watermarks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cardloom.functions.rules import Rule, all_pass, strict_rules
from cardloom.operators.cleaning import clean, deduplicate
from cardloom.operators.profile import union_sketches
from cardloom.schema import EVENT_TIME, KEY, LABEL
from cardloom.session import use_scalable_state
from cardloom.sources.snapshots import merge_batch

ARRIVED = "_arrived"
BLOCK_IDS = 10_000_000  # ids in a block of a merged table: about half a gigabyte


def clean_stream(
    rows: DataFrame,
    rules: Sequence[Rule] | None = None,
    watermark: str = "40 days",
    key: str = KEY,
    combine: bool = True,
) -> DataFrame:
    """Rule filter and de-duplication of newly arrived rows.

    Copies of a transaction are recognised as long as they arrive within the watermark, which
    also bounds the state. The watermark follows the clock of arrival, not the transactions'
    own times: a wrong date in one row must not make all others late. Across batches the copy
    that arrives first stays. The copies of one transaction may fill a large part of a batch and
    would then all land in one task; ``combine`` thins them out before the shuffle, and keeps the
    earliest of those it sees together.
    """
    passed = rows.filter(all_pass(rules or strict_rules()))
    if combine:
        passed = passed.mapInArrow(_earliest(key), passed.schema)
    arrived = passed.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, watermark)
    return arrived.dropDuplicatesWithinWatermark([key]).drop(ARRIVED)


def _earliest(key: str):
    """Keep one row per key of each Arrow batch: the earliest."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if pc.count_distinct(batch.column(key), mode="all").as_py() == batch.num_rows:
                yield batch
                continue
            ordered = batch.take(pc.sort_indices(batch, [(EVENT_TIME, "ascending")]))
            places = pa.table({"key": ordered.column(key), "place": pa.array(range(batch.num_rows))})
            firsts = places.group_by("key").aggregate([("place", "min")])["place_min"]
            yield ordered.take(pc.unique(firsts).sort())

    return thin


def misdated_rows(scored: DataFrame, arrived: str = "current_timestamp()") -> DataFrame:
    """The rows that ``window_metrics`` leaves out of a stream: dated after their arrival, or without a date."""
    return scored.filter(f"{EVENT_TIME} IS NULL OR {EVENT_TIME} > {arrived}")


def window_metrics(scored: DataFrame, window: str = "1 day", watermark: str = "1 day",
                   arrived: str = "current_timestamp()") -> DataFrame:
    """Model metrics per tumbling window, emitted once the window is closed.

    Of a stream, rows dated after ``arrived`` (SQL) do not come in: one of them would move the
    watermark and make all true rows late. ``misdated_rows`` has them. Rows that come after their
    window was emitted are left out; ``merge_windows`` enters them.
    """
    if scored.isStreaming:
        scored = scored.filter(f"{EVENT_TIME} <= {arrived}")
    counted = (
        scored.withWatermark(EVENT_TIME, watermark)
        .groupBy(F.window(EVENT_TIME, window).alias("w"))
        .agg(
            F.expr("count(*) AS rows"),
            F.expr("count_if(prediction = 1) AS predicted_fraud"),
            F.expr(f"count_if({LABEL} = 1) AS known_fraud"),
            F.expr("avg(score) AS mean_score"),
        )
    )
    return counted.selectExpr(
        "w.start AS window_start", "w.end AS window_end", "rows", "predicted_fraud", "known_fraud", "mean_score",
        "predicted_fraud / rows AS predicted_fraud_rate",
    )


# A window's row in the table that monitoring keeps: sums, which further rows add to.
WINDOW_SUMS = {"rows": "count(*)", "predicted_fraud": "count_if(prediction = 1)", "known_fraud": f"count_if({LABEL} = 1)",
               "scored": "count(score)", "score_sum": "coalesce(sum(score), 0D)"}
_DAYS = "unix_date(CAST(window_start AS DATE)) DIV 64"  # days of a block of the table of windows


def window_sums(scored: DataFrame, window: str = "1 day") -> DataFrame:
    """``(window_start, window_end, ...)``: what can be added up of each window's metrics; rows without a date have none."""
    counted = scored.where(f"{EVENT_TIME} IS NOT NULL").groupBy(F.window(EVENT_TIME, window).alias("w")).agg(
        *(F.expr(f"{sql} AS {name}") for name, sql in WINDOW_SUMS.items()))
    return counted.select("w.start", "w.end", *WINDOW_SUMS).withColumnsRenamed({"start": "window_start", "end": "window_end"})


def metrics_of_sums(sums: DataFrame) -> DataFrame:
    """The columns of ``window_metrics``."""
    return sums.selectExpr(
        "window_start", "window_end", "rows", "predicted_fraud", "known_fraud", "score_sum / nullif(scored, 0) AS mean_score",
        "predicted_fraud / rows AS predicted_fraud_rate")


def merge_windows(batch: DataFrame, path: str, source: str, number: int, window: str = "1 day") -> bool:
    """Add a batch of scored rows to the table of window sums at ``path``, once; late rows go where they belong."""
    def added(both: DataFrame) -> DataFrame:
        return both.groupBy("window_start", "window_end").agg(*(F.sum(name).alias(name) for name in WINDOW_SUMS))

    return merge_batch(window_sums(batch, window), path, _DAYS, added, source, number)


def merge_key_sketches(daily: DataFrame, path: str, source: str, number: int) -> bool:
    """Put a batch of ``daily_key_sketches`` into the table at ``path``, once; rows without a date have a block of their own."""
    block = "coalesce(unix_date(day) DIV 64, -1000000)"
    return merge_batch(daily, path, block, union_sketches, source, number)


def merge_transactions(batch: DataFrame, path: str, source: str, number: int, rules: Sequence[Rule] | None = None,
                       key: str = KEY, block_ids: int = BLOCK_IDS) -> bool:
    """Clean a batch of rows and merge it into the table at ``path``, once.

    Of the copies of a transaction the earliest stays, also if it comes last, so the table equals the one
    that cleaning all rows together gives, however they are dealt to batches. Copies share their id, so
    a block of the table holds ``block_ids`` following ids, and only blocks of the batch's ids are written.
    """
    cleaned = clean(batch, rules or strict_rules())
    block = f"coalesce(floor({key} / {block_ids}), -1)"
    return merge_batch(cleaned, path, block, lambda both: deduplicate(both, key), source, number)


def run_batches(rows: DataFrame, checkpoint: str, enter: Callable[[DataFrame, int], object]) -> None:
    """Hand the input that has arrived since the last run to ``enter``, batch by batch, and stop.

    A batch may come again after a failure, with its number.
    """
    run_available(rows.writeStream.foreachBatch(enter).option("checkpointLocation", checkpoint))


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what has arrived since the last run, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_to_files(rows: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> DataFrame:
    """Run a stream over the available input into a Parquet table and return that table."""
    use_scalable_state(rows.sparkSession)
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    run_available(writer.option("checkpointLocation", checkpoint))
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
