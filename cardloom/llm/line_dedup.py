"""Line de-duplication: hash lines, count documents by hash, drop repeats, reassemble by position.

Texts are scanned three times and shuffled once, for the reassembly; lines travel as two hash
words each. Counting combines before the shuffle, so a line that most documents hold costs a
row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import ascii_lower, quoted, stage, text_batches, unpacked

WHITE = r"' \t\n\u000B\u000C\r'"  # SQL literals have no \f


def hashed_lines(rows: DataFrame, least: int) -> DataFrame:
    """``(_id, _check, at, h1, h2)`` for each line of ``rows`` whose key has ``least`` code points.

    Two words make 128 bits: among 10^13 lines a chance collision has odds below one in 10^12.
    """
    lines = rows.selectExpr("_id", "_check", r"posexplode(split(_text, '\n', -1)) AS (at, line)").selectExpr(
        "_id", "_check", "at", f"btrim(line, {WHITE}) AS line").where(f"char_length(line) >= {least}")
    return lines.selectExpr("_id", "_check", "at", f"{ascii_lower('line')} AS line").selectExpr(
        "_id", "_check", "at", "xxhash64(line) AS h1", "xxhash64('line', line) AS h2")


def repeated_lines(lines: DataFrame, documents: int) -> DataFrame:
    """``(h1, h2, low)``: lines in at least ``documents`` documents, and the smallest key of these.

    For two documents the smallest and the largest key tell; for more the distinct pairs are counted.
    Rows with a NULL key count together as one document, above all others.
    """
    extent = [F.expr("min(_id) AS low"), F.expr("max(_id) AS high"), F.expr("bool_or(_id IS NULL) AS none")]
    if documents <= 2:
        found = lines.groupBy("h1", "h2").agg(*extent).where("low <> high OR (none AND low IS NOT NULL)")
    else:
        found = lines.select("h1", "h2", "_id").distinct().groupBy("h1", "h2").agg(
            *extent, F.count("*").alias("docs")).where(f"docs >= {documents}")
    return found.select("h1", "h2", "low")


def dedup_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = 10, documents: int = 2,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` before dropping, ``n_dropped`` and ``kept_sha256``.

    Lines end at \\n. A line's key is the line without white space at its ends, A-Z lower-cased.
    Keys of at least ``least`` code points in at least ``documents`` documents stay in the
    document with the smallest key only, there with all their lines. Shorter ones always stay.

    NULL and empty texts have one empty line, which stays. Rows that repeat a key are one
    document for the count; each is reassembled by itself. A NULL key is the largest. An
    empty table gives an empty result. Columns named like a result are replaced.
    """
    columns = docs.columns if keep is None else list(keep)
    rows = docs.select(
        F.struct(*(F.col(quoted(name)) for name in columns)).alias("_row"), F.col(quoted(key)).alias("_id"),
        F.expr(f"coalesce({quoted(text)}, '')").alias("_text"),
    ).selectExpr("*", "xxhash64(_text) AS _check")
    lines = hashed_lines(rows, least)
    repeated = stage(repeated_lines(lines, documents), "repeated-lines")
    drops = lines.join(repeated, ["h1", "h2"]).where("NOT (_id <=> low)").groupBy("_id", "_check").agg(
        F.collect_set("at").alias("drops")).withColumnsRenamed({"_id": "_of", "_check": "_of_check"})

    @F.pandas_udf("kept_text string, n_lines long, n_dropped long, kept_sha256 string")
    def reassembled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, dropped in batches:
            found = []
            for content, places in zip(texts, dropped):
                parts = content.split("\n")
                gone = set() if places is None else set(places)
                kept = "\n".join(part for at, part in enumerate(parts) if at not in gone) if gone else content
                found.append((kept, len(parts), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
            yield pd.DataFrame(found, columns=["kept_text", "n_lines", "n_dropped", "kept_sha256"])

    text_batches(docs.sparkSession)
    joined = rows.join(drops, F.expr("_id <=> _of AND _check = _of_check"), "left")
    result = joined.select("_row", reassembled("_text", "drops").alias("_new"))
    return unpacked(result, columns, kept_text="_new.kept_text", n_lines="_new.n_lines",
                    n_dropped="_new.n_dropped", kept_sha256="_new.kept_sha256")
