"""Stream job: transactions from one topic or folder, scored into another."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cardloom.functions.rules import Rule, all_pass, strict_rules
from cardloom.functions.scoring import LinearModel
from cardloom.operators.cleaning import deduplicate
from cardloom.operators.modelling import load_model, score_rows
from cardloom.schema import KEY, transactions_schema
from cardloom.session import add_store_arguments, job, store_conf, use_scalable_state
from cardloom.sources.feed import rejected_of, well_formed_of
from cardloom.sources.messages import read_marked_messages, read_stream, stream_writer, write_batch
from cardloom.sources.snapshots import drop_old_versions, merge_batch, read_snapshot
from cardloom.sources.tables import stage
from cardloom.streaming.jobs import BLOCK_IDS, clean_stream

SEEN = "transaction_id LONG, first_batch LONG"


def start(spark: SparkSession, model_path: str, source_format: str, sink_format: str, checkpoint: str,
          source: str | None = None, sink: str | None = None, source_options: dict[str, str] | None = None,
          sink_options: dict[str, str] | None = None, watermark: str = "40 days",
          every: str | None = None, first_day: str = "2018-01-01", end_day: str | None = None) -> StreamingQuery:
    """Start scoring alone. Without ``every``, the input at hand is processed and the query stops.

    Rows that fail a rule, undecodable messages and copies are left out; ``start_routed`` writes them too.
    """
    use_scalable_state(spark)
    rows = read_stream(spark, source_format, path=source, options=source_options)
    scored = score_rows(clean_stream(rows, strict_rules(first_day, end_day), watermark), load_model(model_path), keep=rows.columns)
    writer = stream_writer(scored, sink_format, checkpoint, sink, sink_options)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_routed(spark: SparkSession, model: str | LinearModel, source_format: str, sink_format: str, checkpoint: str,
                 rejects: str, source: str | None = None, sink: str | None = None,
                 source_options: dict[str, str] | None = None, sink_options: dict[str, str] | None = None,
                 every: str | None = None, first_day: str = "2018-01-01", end_day: str | None = None,
                 enveloped: bool | None = None, block_ids: int = BLOCK_IDS) -> StreamingQuery:
    """Score a stream and lose no row of it: each is in one of three outputs, from one parse.

    The sink gets the first copy of each transaction that passes the rules, with ``score`` and ``prediction``.
    ``REJECTS`` gets undecodable messages and rows that fail a rule, ``(line, reasons)``. ``REJECTS-copies`` says
    how many further copies of a transaction came, ``(transaction_id, copies)``. Each output has a folder for each
    batch; a batch that comes again replaces its own. Which transactions came before is kept in a
    snapshot table below the checkpoint, by blocks of ids: copies are recognised however late they
    come, and a batch reads only the blocks of its own ids.
    """
    schema, rules = transactions_schema(wide_ids=True), strict_rules(first_day, end_day)
    scorer = load_model(model) if isinstance(model, str) else model

    def enter(batch: DataFrame, number: int) -> None:
        parsed = stage(batch, "parsed")
        rejected_of(parsed, rules, schema).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        scored, copies = _first_copies(parsed, rules, f"{checkpoint}/seen", checkpoint, number, block_ids)
        copies.write.mode("overwrite").parquet(f"{rejects}-copies/batch={number}")
        write_batch(score_rows(scored, scorer, keep=schema.names), sink_format, sink, number, sink_options)
        drop_old_versions(spark, f"{checkpoint}/seen")

    rows = read_marked_messages(spark, source_format, schema, source, source_options, enveloped)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return rows.writeStream.foreachBatch(enter).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _first_copies(parsed: DataFrame, rules: list[Rule], seen: str, source: str, number: int,
                  block_ids: int) -> tuple[DataFrame, DataFrame]:
    """Rows of transactions new in this batch, the earliest of each; how many other copies came, by transaction."""
    spark = parsed.sparkSession
    passed = well_formed_of(parsed).filter(all_pass(rules))
    counted = stage(passed.groupBy(KEY).agg(F.expr("count(*) AS rows")), "counted")
    merge_batch(counted.selectExpr(KEY, f"{number}L AS first_batch"), seen, f"floor({KEY} / {block_ids})",
                lambda both: both.groupBy(KEY).agg(F.min("first_batch").alias("first_batch")), source, number)
    known = read_snapshot(spark, seen, spark.createDataFrame([], SEEN).schema)
    marked = stage(counted.join(known, KEY).selectExpr(KEY, "rows", f"first_batch = {number} AS is_new"), "marked")
    scored = deduplicate(passed).join(marked.where("is_new").select(KEY), KEY, "left_semi")
    return scored, marked.selectExpr(KEY, "rows - CAST(is_new AS INT) AS copies").where("copies > 0")


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--model", required=True)
    args.add_argument("--checkpoint", required=True)
    args.add_argument("--source-format", default="kafka")
    args.add_argument("--sink-format", default="kafka")
    args.add_argument("--source")
    args.add_argument("--sink")
    args.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE")
    args.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE")
    args.add_argument("--watermark", default="40 days")
    args.add_argument("--first-day", default="2018-01-01")
    args.add_argument("--end-day", help="leave out transactions from this day on")
    args.add_argument("--rejects", metavar="FOLDER", help="write what is not scored here, and copies to FOLDER-copies")
    args.add_argument("--every", help="trigger interval; without it, stop after the input at hand")
    add_store_arguments(args)
    opts = args.parse_args(argv)
    with job("stream", store_conf(opts)) as spark:
        if opts.rejects:
            query = start_routed(spark, opts.model, opts.source_format, opts.sink_format, opts.checkpoint, opts.rejects,
                                 opts.source, opts.sink, _options(opts.source_option), _options(opts.sink_option), opts.every,
                                 opts.first_day, opts.end_day)
        else:
            query = start(spark, opts.model, opts.source_format, opts.sink_format, opts.checkpoint, opts.source, opts.sink,
                          _options(opts.source_option), _options(opts.sink_option), opts.watermark, opts.every,
                          opts.first_day, opts.end_day)
        query.awaitTermination()


if __name__ == "__main__":
    main()
