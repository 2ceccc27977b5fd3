"""Clean job: text feed -> well-formed rows -> rules -> one row per transaction -> Parquet."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from cardloom.functions.rules import Rule, parity_rules, strict_rules
from cardloom.operators.cleaning import clean
from cardloom.operators.profile import (
    counter_reports, daily_key_sketches, observed_counters, profile_counters, profile_domains, profile_key_count,
)
from cardloom.schema import transactions_schema
from cardloom.session import add_store_arguments, job, scratch_path, sibling_session, store_conf
from cardloom.sources.feed import (
    CORRUPT, malformed_of, read_feed, read_feed_stream, read_marked, read_marked_stream, read_rejects_stream, rejected_of,
    well_formed_of,
)
from cardloom.sources.snapshots import drop_old_versions, open_table, read_snapshot, replace_table
from cardloom.sources.tables import read_table, stage, write_table
from cardloom.streaming.jobs import (
    BLOCK_IDS, clean_stream, drain_to_files, merge_key_sketches, merge_transactions, run_batches,
)

DAYS = ("2018-01-01", None)  # the first day that passes, and the first that does no more, if any
TX_DATE = "CAST(tx_datetime AS DATE) AS tx_date"


@dataclass(frozen=True)
class ParsedFeed:
    """A feed after its one parse: ``rows`` and ``malformed`` read the stored result, ``counts`` came with its write."""

    rows: DataFrame
    malformed: DataFrame
    counts: dict[str, int]


def parse_once(spark: SparkSession, feed: str, rules: list[Rule], wide_ids: bool = True, glob: str = "*.txt") -> ParsedFeed:
    """Parse every line of a feed once: rows, malformed lines and all plain counters from a single scan of the text.

    The marked lines are stored as Parquet and counted on their way. A counter has each line once, also
    if tasks fail: only the task whose file is kept adds its counts.
    """
    schema, counted = transactions_schema(wide_ids), Observation("feed")
    marked = read_marked(sibling_session(spark), feed, schema, glob)
    marked = marked.observe(counted, *observed_counters(schema, rules, f"({CORRUPT} IS NOT NULL)"))
    path = scratch_path(spark, "parsed")
    marked.write.parquet(path)
    parsed = spark.read.schema(marked.schema).parquet(path)
    return ParsedFeed(well_formed_of(parsed), malformed_of(parsed), dict(counted.get))


def clean_feed(spark: SparkSession, feed: str, output: str, strict: bool = True, wide_ids: bool = True,
               glob: str = "*.txt", rejects: str | None = None, by_day: bool = False,
               days: tuple[str, str | None] = DAYS, profile_to: str | None = None, snapshot: bool = False) -> DataFrame:
    """Clean a feed into a Parquet table and return that table.

    ``strict=False`` applies the rules of the known cleaned dataset, else ``days`` are the first day
    and the day after the last, if any. ``rejects`` also keeps the malformed lines and ``profile_to``
    the reports on the uncleaned rows; with either, the text is still parsed once. ``by_day``
    partitions the table by transaction date. With ``snapshot`` the output is a snapshot table: the
    old rows stay readable until the new ones are complete, on object stores too.
    """
    if snapshot and by_day:
        raise ValueError("a snapshot table is partitioned by its blocks, not by day")
    rules = strict_rules(*days) if strict else parity_rules()
    if rejects or profile_to:
        parsed = parse_once(spark, feed, rules, wide_ids, glob)
        rows = parsed.rows
        if rejects:
            write_table(parsed.malformed, rejects)
        for name, report in (feed_reports(parsed) if profile_to else {}).items():
            write_table(report, f"{profile_to}/{name}")
    else:
        rows = read_feed(spark, feed, transactions_schema(wide_ids), glob)
    cleaned = clean(rows, rules)
    if snapshot:
        replace_table(cleaned, output)
        drop_old_versions(spark, output)
        return open_table(spark, output)
    if by_day:
        cleaned = cleaned.selectExpr("*", TX_DATE)
    write_table(cleaned, output, partition_by="tx_date" if by_day else None)
    return read_table(spark, output)


def feed_reports(parsed: ParsedFeed) -> dict[str, DataFrame]:
    """All reports of :func:`profile` on a parsed feed, and its ``lines``; the plain counters are there already."""
    counted = counter_reports(parsed.rows.sparkSession, parsed.counts)
    return {**counted, "domains": profile_domains(parsed.rows), "keys": profile_key_count(parsed.rows)}


def clean_new_files(spark: SparkSession, feed: str, output: str, checkpoint: str, strict: bool = True,
                    wide_ids: bool = True, glob: str = "*.txt", watermark: str = "40 days",
                    rejects: str | None = None, by_day: bool = False, days: tuple[str, str | None] = DAYS) -> DataFrame:
    """Clean the files that arrived since the last run and append them to the table.

    The checkpoint remembers the files read and the transactions that arrived within the
    watermark. ``rejects`` gets the malformed lines of these files and, as JSON, the rows that
    fail a rule, each with its reasons; it has a checkpoint of its own below the other.
    """
    schema, rules = transactions_schema(wide_ids), strict_rules(*days) if strict else parity_rules()
    cleaned = clean_stream(read_feed_stream(spark, feed, schema, glob), rules, watermark)
    if by_day:
        cleaned = cleaned.selectExpr("*", TX_DATE)
    table = drain_to_files(cleaned, output, checkpoint, partition_by="tx_date" if by_day else None)
    if rejects:
        drain_to_files(read_rejects_stream(spark, feed, rules, schema, glob), rejects, f"{checkpoint}/rejects")
    return table


def merge_new_files(spark: SparkSession, feed: str, output: str, checkpoint: str, strict: bool = True,
                    wide_ids: bool = True, glob: str = "*.txt", rejects: str | None = None,
                    days: tuple[str, str | None] = DAYS, block_ids: int = BLOCK_IDS,
                    files_per_batch: int | None = None, sketches: str | None = None) -> DataFrame:
    """Clean the files that arrived since the last run, merge them into the table and return the whole table.

    The table equals what ``clean_feed`` makes of all files together, whatever the order in which they
    arrive; see ``merge_transactions``. The files of a batch are parsed once: what cleaning leaves out
    goes to ``rejects``, by batch, with its reasons. ``sketches`` is a table of the distinct ids of each
    day among the uncleaned rows, for ``sketched_key_count``. A batch that comes again changes nothing.
    """
    schema, rules = transactions_schema(wide_ids), strict_rules(*days) if strict else parity_rules()

    def enter(batch: DataFrame, number: int) -> None:
        parsed = stage(batch, "parsed")
        if rejects:
            rejected_of(parsed, rules, schema).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        if sketches:
            merge_key_sketches(daily_key_sketches(well_formed_of(parsed)), sketches, checkpoint, number)
            drop_old_versions(spark, sketches)
        merge_transactions(well_formed_of(parsed), output, checkpoint, number, rules, block_ids=block_ids)
        drop_old_versions(spark, output)

    run_batches(read_marked_stream(spark, feed, schema, glob, files_per_batch=files_per_batch), checkpoint, enter)
    return read_snapshot(spark, output, schema)


def profile(rows: DataFrame) -> dict[str, DataFrame]:
    """All data-quality reports on uncleaned rows, in three passes.

    Whatever is a plain counter is counted in the first pass, whose single row is staged.
    """
    counters = stage(profile_counters(rows, strict_rules()), "profile")
    return {
        "missing": counters.selectExpr("inline(missing)"),
        "violations": counters.selectExpr("violations.*"),
        "reject_reasons": counters.selectExpr("inline(reasons)").filter("rows > 0"),
        "domains": profile_domains(rows),
        "keys": profile_key_count(rows),
    }


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--feed", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--rejects")
    args.add_argument("--parity-rules", action="store_true")
    args.add_argument("--narrow-ids", action="store_true", help="ids are INT; larger ones are malformed")
    args.add_argument("--first-day", default=DAYS[0])
    args.add_argument("--end-day", help="reject transactions from this day on")
    args.add_argument("--watermark", default="40 days", help="how long copies of a transaction are recognised")
    args.add_argument("--by-day", action="store_true")
    args.add_argument("--checkpoint", help="clean only files that are new since the last run with this folder")
    args.add_argument("--merge", action="store_true",
                      help="with --checkpoint: merge new files into a snapshot table, which then equals the full run")
    args.add_argument("--profile", metavar="FOLDER", help="write the reports of the feed below this folder")
    args.add_argument("--snapshot", action="store_true", help="keep the old table readable until the new one is complete")
    args.add_argument("--sketches", metavar="FOLDER", help="with --merge: a table of the distinct ids of each day")
    add_store_arguments(args)
    opts = args.parse_args(argv)
    days = opts.first_day, opts.end_day
    with job("clean", store_conf(opts)) as spark:
        if opts.checkpoint and opts.merge:
            merge_new_files(spark, opts.feed, opts.output, opts.checkpoint, not opts.parity_rules, not opts.narrow_ids,
                            rejects=opts.rejects, days=days, sketches=opts.sketches)
        elif opts.checkpoint:
            clean_new_files(spark, opts.feed, opts.output, opts.checkpoint, not opts.parity_rules, not opts.narrow_ids,
                            watermark=opts.watermark, rejects=opts.rejects, by_day=opts.by_day, days=days)
        else:
            clean_feed(spark, opts.feed, opts.output, not opts.parity_rules, not opts.narrow_ids,
                       rejects=opts.rejects, by_day=opts.by_day, days=days, profile_to=opts.profile, snapshot=opts.snapshot)
        if opts.profile and opts.checkpoint:
            parsed = parse_once(spark, opts.feed, strict_rules(*days), not opts.narrow_ids)
            for name, report in feed_reports(parsed).items():
                write_table(report, f"{opts.profile}/{name}")


if __name__ == "__main__":
    main()
