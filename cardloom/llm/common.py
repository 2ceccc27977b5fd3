"""What several operators share: text expressions, staging and carried rows.

Operators keep the caller's columns in one struct called ``_row`` while they work, so a
column of any name may come along. A result column replaces an input column of its name.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.sources.tables import stage

__all__ = ["ascii_lower", "by_key", "quoted", "shuffle_partitions", "stage", "text_batches", "unpacked", "word_count"]

BATCH_ROWS = 1000


def quoted(name: str) -> str:
    """A column name as SQL."""
    return f"`{name.replace('`', '``')}`"


def ascii_lower(text: str) -> str:
    """SQL: lower-case A-Z only, whatever the other characters are."""
    return f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def word_count(text: str) -> str:
    """SQL: number of words as BIGINT; NULL has none."""
    return f"CAST(coalesce(regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0) AS BIGINT)"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of BATCH_ROWS rows at most.

    A batch is held by the JVM and by the worker at once, so the default of 10,000 rows takes
    hundreds of megabytes per core where texts are long. A lower setting is left alone.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def unpacked(df: DataFrame, columns: list[str], **results: str) -> DataFrame:
    """The input's ``columns`` out of ``_row``, then the results (name to SQL)."""
    clash = {name.lower() for name in results}
    kept = [F.col("_row")[name].alias(name) for name in columns if name.lower() not in clash]
    return df.select(*kept, *(F.expr(sql).alias(name) for name, sql in results.items()))


def by_key(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches cut so that each piece holds all rows of its keys; a key's rows may span batches."""
    rest: list[pd.DataFrame] = []
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            done = pd.concat(rest, ignore_index=True) if rest else None
            rest = []
        elif not len(batch):
            continue
        else:
            last = (batch[keys] == batch[keys].iloc[-1]).all(axis=1).to_numpy()
            start = len(batch) if not last.all() else 0
            if start:  # the last key starts behind the last row of another
                start = int(len(last) - last[::-1].argmin())
            done = pd.concat([*rest, batch.iloc[:start]], ignore_index=True) if start else None
            rest = [batch.iloc[start:]] if start else [*rest, batch]
            if start == 0 and len(rest) > 1 and (rest[-2][keys].iloc[-1] != batch[keys].iloc[0]).any():
                done, rest = pd.concat(rest[:-1], ignore_index=True), rest[-1:]
        if done is not None and len(done):
            yield done
