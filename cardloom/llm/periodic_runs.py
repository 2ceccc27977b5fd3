"""Periodic runs: stretches of words that repeat with a short period, found in one pass over a text.

A run of period q matches every word with the one q before it: on the diagonal of lag q, matches
follow each other without a gap. The pass goes through the words and holds the active diagonals
only: those whose last match is the word before. The earlier occurrences of the current word open
diagonals and lengthen active ones; a diagonal that ends long enough emits its run at once.

What keeps the active diagonals few, without losing a run of at least ``MIN_LENGTH`` words and
``MIN_COPIES`` periods:

* Such a run matches at least five words one after the other. So an occurrence counts where the
  four words before it agree as well, and a text without any repeated five words has no run.
* A run of lag q matches at least 2^k places of five, 2^k being the largest power of two up to q.
  So a diagonal is opened at multiples of 2^k only; its earlier matches are counted backwards.
* Inside the run of an active diagonal q, a lag that is a multiple of q ends with it and is no
  smallest period, so it is not opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, text_batches, unpacked

MIN_LENGTH = 6
MIN_COPIES = 4
_CONTEXT = 5  # words in a row that each run matches: the least of max(6 - q, 3q) over all q


def repeated_fives(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose five last words end at another place too, in order, and a number for these five."""
    if len(numbers) < _CONTEXT + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = numbers[_CONTEXT - 1:]
    for back in range(1, _CONTEXT):  # pairs of (number so far, word before) are numbered anew: no collisions
        width = np.int64(numbers.max()) + 1
        codes = np.unique(codes * width + numbers[_CONTEXT - 1 - back:len(numbers) - back], return_inverse=True)[1]
    often = np.bincount(codes)[codes] > 1
    return np.flatnonzero(often) + _CONTEXT - 1, codes[often]


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period."""
    n = len(words)
    if n < MIN_LENGTH:
        return []
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(word, len(known)) for word in words), np.int64, n)
    if n - len(known) < _CONTEXT:
        return []
    places, codes = repeated_fives(numbers)
    if not len(places):
        return []
    w, last = numbers.tolist(), n // MIN_COPIES
    seen: dict[int, list[int]] = {}
    active: dict[int, int] = {}  # lag -> start of its run
    runs: list[tuple[int, int, int]] = []
    before = -1
    for i, code in zip(places.tolist(), codes.tolist()):
        if active:
            if i != before + 1:
                _end(active, list(active), before + 1, runs)
            else:
                _end(active, [lag for lag in active if w[i] != w[i - lag]], i, runs)
        earlier = seen.setdefault(code, [])
        if earlier:
            most = min(last, 2 * (i & -i) - 1) if i else 0
            for j in reversed(earlier):
                lag = i - j
                if lag > most:
                    break
                # Only lags of the power of two that divides the place, or of a smaller one.
                if lag in active or any(lag % q == 0 and j >= start for q, start in active.items()):
                    continue
                k = j - _CONTEXT
                while k >= 0 and w[k] == w[k + lag]:
                    k -= 1
                active[lag] = k + 1
        earlier.append(i)
        before = i
    _end(active, list(active), before + 1, runs)
    return sorted((start, length, lag) for start, length, lag in runs)


def _end(active: dict[int, int], lags: list[int], end: int, runs: list[tuple[int, int, int]]) -> None:
    """Close diagonals whose last match is the word before ``end``; emit the runs among them."""
    ended: list[tuple[int, int]] = []
    for lag in sorted(lags):
        start = active.pop(lag)
        if end - start >= max(MIN_LENGTH, MIN_COPIES * lag):
            if not any(lag % q == 0 and first <= start for q, first in ended):
                ended.append((lag, start))
                runs.append((start, end - start, lag))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside runs, and each run's first period, unless another run drops it."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def with_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", repeat: str | None = None) -> DataFrame:
    """``docs``, all columns, with ``runs`` (spans of words, by start, then period) and ``collapsed`` (a text).

    Words are longest stretches without ASCII white space. A run has at least MIN_LENGTH words and
    MIN_COPIES periods and is as long as its smallest period allows; ``collapsed`` keeps of each run its
    first period, words joined by one space. NULL, empty and blank texts have no runs and an empty
    collapsed text. A text of any length is read whole, with memory in proportion to it. Rows are
    independent of each other, so repeated rows and NULL keys give a row each. A column of the
    input named like a result is replaced.

    ``repeat`` is SQL over ``_id`` (the key) and ``_n`` (number of words) for a struct of two BIGINTs
    ``from`` and ``period``, or NULL: from word ``from`` on, the text is read as if its words
    repeated with that period.
    """
    size = "CAST(regexp_count(coalesce(_text, ''), '[^\\\\x20\\\\x09-\\\\x0D]+') AS BIGINT)"
    made = f"transform(array({size}), _n -> {repeat})[0]" if repeat else "CAST(NULL AS STRUCT<from: BIGINT, period: BIGINT>)"

    @F.pandas_udf(f"runs {RUNS}, collapsed string")
    def search(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, periods in batches:
            found = []
            for content, start, period in zip(texts, starts, periods):
                words = (content or "").encode().split()  # bytes: just the six ASCII white-space characters
                if period == period and period is not None:
                    start, period = int(start), int(period)
                    block = words[start:start + period]
                    words = words[:start] + (block * (1 + (len(words) - start) // period))[:len(words) - start]
                runs = find_runs(words)
                found.append(([{"start": s, "length": length, "period": q} for s, length, q in runs],
                              b" ".join(kept_words(words, runs)).decode()))
            yield pd.DataFrame(found, columns=["runs", "collapsed"])

    text_batches(docs.sparkSession)
    whole = docs.select(F.struct(*(F.col(quoted(name)) for name in docs.columns)).alias("_row")).selectExpr(
        "_row", f"_row.{quoted(key)} AS _id", f"_row.{quoted(text)} AS _text").selectExpr("*", f"{made} AS _made")
    searched = whole.withColumn("_found", search("_text", F.col("_made.from"), F.col("_made.period")))
    return unpacked(searched, docs.columns, runs="_found.runs", collapsed="_found.collapsed")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of ``with_runs``: number of runs, the run of the greatest exponent, and two digests.

    The greatest of length / period; of those that tie the smallest start, then the smallest period.
    """
    # Two fractions are compared by their cross products, which are exact.
    best = ("aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (best, run) -> "
            "IF(best IS NULL OR run.length * best.period > best.length * run.period, run, best))")
    lines = "concat(run.start, ',', run.length, ',', run.period, chr(10))"
    return found.selectExpr(quoted(key), "runs", "collapsed", f"{best} AS best").selectExpr(
        quoted(key), "CAST(size(runs) AS BIGINT) AS n_runs", "best.start AS start", "best.length AS length",
        "best.period AS period", "1000 * best.length DIV best.period AS exponent_milli",
        f"sha2(array_join(transform(runs, run -> {lines}), ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256")
