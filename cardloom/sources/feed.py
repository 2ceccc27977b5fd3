"""The raw text feed: header-less CSV files with ``#`` comment lines.

Spark judges a CSV line only by the columns a query asks for, so a narrow select or a
``count()`` would let malformed lines through. Every read here goes through one
PERMISSIVE scan with a corrupt-record column, and the accept test mentions all columns;
the verdict on a line is then the same whatever the query selects afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, types as T
from pyspark.sql.streaming import DataStreamReader

from cardloom.functions.rules import Rule, failing_names
from cardloom.schema import transactions_schema

CORRUPT = "_malformed_line"


def _scan(reader: DataFrameReader | DataStreamReader, path: str, schema: T.StructType, glob: str,
          comment: str) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"header": False, "comment": comment, "pathGlobFilter": glob, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": CORRUPT}
    return reader.schema(with_corrupt).options(**options).csv(path)


def _reads_every_column(schema: T.StructType) -> str:
    """Always true, but keeps each column in the scan so that each is parsed."""
    empty_fields = " + ".join(f"CAST({name} IS NULL AS INT)" for name in schema.names)
    return f"{empty_fields} <= {len(schema.names)}"


def _well_formed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.filter(f"{CORRUPT} IS NULL AND {_reads_every_column(schema)}").drop(CORRUPT)


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    glob: str = "*.txt",
    comment: str = "#",
) -> DataFrame:
    """Well-formed feed rows; malformed lines are dropped."""
    schema = schema or transactions_schema()
    return _well_formed(_scan(spark.read, path, schema, glob, comment), schema)


def read_feed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    glob: str = "*.txt",
    comment: str = "#",
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same rows as a stream of the files that arrive in the folder."""
    schema = schema or transactions_schema()
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _well_formed(_scan(reader, path, schema, glob, comment), schema)


def read_rejected_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    glob: str = "*.txt",
    comment: str = "#",
) -> DataFrame:
    """The malformed lines that :func:`read_feed` drops, as ``(line)``."""
    schema = schema or transactions_schema()
    rows = _scan(spark.read, path, schema, glob, comment)
    return rows.filter(f"{CORRUPT} IS NOT NULL AND {_reads_every_column(schema)}").selectExpr(f"{CORRUPT} AS line")


def read_marked_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    glob: str = "*.txt",
    comment: str = "#",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Every line of the arriving files, once parsed: the columns, or the line in ``CORRUPT``."""
    schema = schema or transactions_schema()
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _scan(reader, path, schema, glob, comment).filter(_reads_every_column(schema))


def read_marked(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    glob: str = "*.txt",
    comment: str = "#",
) -> DataFrame:
    """Every line of the feed, once parsed: the columns, or the line in ``CORRUPT``."""
    schema = schema or transactions_schema()
    return _scan(spark.read, path, schema, glob, comment).filter(_reads_every_column(schema))


def well_formed_of(marked: DataFrame) -> DataFrame:
    """The well-formed rows of lines that were parsed with their mark and stored."""
    return marked.filter(f"{CORRUPT} IS NULL").drop(CORRUPT)


def malformed_of(marked: DataFrame) -> DataFrame:
    """The malformed lines of stored marked rows, as ``(line)``."""
    return marked.filter(f"{CORRUPT} IS NOT NULL").selectExpr(f"{CORRUPT} AS line")


def rejected_of(marked: DataFrame, rules: Sequence[Rule], schema: T.StructType) -> DataFrame:
    """What cleaning leaves out of marked rows, ``(line, reasons)``; copies of a transaction are not among it."""
    return marked.selectExpr(
        f"coalesce({CORRUPT}, to_json(struct({', '.join(schema.names)}))) AS line",
        f"CASE WHEN {CORRUPT} IS NOT NULL THEN array('malformed') ELSE {failing_names(rules)} END AS reasons",
    ).filter("size(reasons) > 0")


def read_rejects_stream(
    spark: SparkSession,
    path: str,
    rules: Sequence[Rule],
    schema: T.StructType | None = None,
    glob: str = "*.txt",
    comment: str = "#",
) -> DataFrame:
    """What cleaning the stream leaves out: ``(line, reasons)``.

    A malformed line has the reason ``malformed``; a row that fails rules is given as JSON with their names.
    """
    schema = schema or transactions_schema()
    return rejected_of(_scan(spark.readStream, path, schema, glob, comment).filter(_reads_every_column(schema)), rules, schema)


def write_feed_lines(lines: DataFrame, path: str) -> None:
    """Write a one-column DataFrame of lines as ``*.txt`` feed files."""
    lines.write.mode("overwrite").text(path)
