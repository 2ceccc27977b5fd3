"""Message topics: any streaming source or sink whose rows carry a key and a JSON value.

The format is a parameter. ``kafka`` needs the Spark Kafka package on the class path;
file formats use the same code without the envelope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from cardloom.schema import KEY, transactions_schema
from cardloom.sources.feed import CORRUPT, well_formed_of

ENVELOPE_FORMATS = ("kafka",)

# The default JSON timestamp stops at milliseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def encode_messages(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows to ``(key, value)``; the value is the whole row as JSON, NULL fields included."""
    value = F.to_json(F.struct(*df.columns), {**_JSON, "ignoreNullFields": "false"})
    return df.select(F.expr(f"CAST({key} AS STRING) AS key"), value.alias("value"))


def decode_marked(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """A row for every message: its columns, or, where the value is no JSON of this schema, its text in ``CORRUPT``.

    A message without a value is marked with an empty text.
    """
    schema = schema or transactions_schema(wide_ids=True)
    options = {**_JSON, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.expr("CAST(value AS STRING)"), _with_corrupt(schema), options)
    rows = df.select(parsed.alias("row"), F.expr("CAST(value AS STRING) AS text"))
    mark = f"CASE WHEN row IS NULL OR row.{CORRUPT} IS NOT NULL THEN coalesce(row.{CORRUPT}, text, '') END AS {CORRUPT}"
    return rows.selectExpr(*[f"row.{name}" for name in schema.names], mark)


def decode_messages(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """``(key, value)`` messages to rows. Values that are no JSON of this schema are dropped; see ``decode_marked``."""
    return well_formed_of(decode_marked(df, schema))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_stream(
    spark: SparkSession,
    source_format: str,
    schema: T.StructType | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of transactions from a topic (enveloped) or from files (not enveloped)."""
    marked = read_marked_messages(spark, source_format, schema, path, options)
    return well_formed_of(marked)


def read_marked_messages(
    spark: SparkSession,
    source_format: str,
    schema: T.StructType | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
    enveloped: bool | None = None,
) -> DataFrame:
    """The same with a row for every message, undecodable ones marked in ``CORRUPT``.

    ``enveloped`` says that a file source holds ``(key, value)`` messages.
    """
    schema = schema or transactions_schema(wide_ids=True)
    reader = spark.readStream.format(source_format).options(**(options or {}))
    if source_format in ENVELOPE_FORMATS:
        return decode_marked(reader.load(), schema)
    if enveloped:
        return decode_marked(reader.schema("key STRING, value STRING").load(path), schema)
    return reader.schema(schema).load(path).withColumn(CORRUPT, F.lit(None).cast("string"))


def write_batch(df: DataFrame, sink_format: str, path: str | None, number: int, options: dict[str, str] | None = None,
                key: str = KEY) -> None:
    """One micro-batch to a topic (enveloped), or to a folder of its own below ``path``.

    A batch that comes again replaces its folder; a topic gets it again.
    """
    if sink_format in ENVELOPE_FORMATS:
        encode_messages(df, key).write.format(sink_format).options(**(options or {})).save()
    else:
        df.write.format(sink_format).mode("overwrite").options(**(options or {})).save(f"{path}/batch={number}")


def stream_writer(
    df: DataFrame,
    sink_format: str,
    checkpoint: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
    key: str = KEY,
) -> DataStreamWriter:
    """An append writer to a topic (enveloped) or to files; the caller sets the trigger."""
    rows = encode_messages(df, key) if sink_format in ENVELOPE_FORMATS else df
    writer = (
        rows.writeStream.format(sink_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    return writer.option("path", path) if path else writer
