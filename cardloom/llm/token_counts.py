"""Token counts of fields and sections by offset-mapped attribution.

A document's fields are joined and encoded once, as a whole, with a byte-level BPE. Each token
covers a span of the joined text. The spans are joined with those of the sections, two sorted
lists of intervals, and a token that crosses a boundary goes to one section by an explicit rule:

* ``majority``: where most of its characters lie, of equal parts the first;
* ``start``: where its first character lies;
* ``end``: where its last character lies.

So the counts of a document's sections add up to its tokens. Encoding sections one by one would
not give that.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, text_batches

RULES = ("majority", "start", "end")
SEPARATOR = "\n"


@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str):
    """A byte-level BPE from a file of ranks, and the number of bytes of each of its tokens."""
    import tiktoken

    with open(ranks, "rb") as lines:
        pieces = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(pieces.values()) + 1, np.int64)
    for piece, rank in pieces.items():
        sizes[rank] = len(piece)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=pieces, special_tokens={}), sizes


def token_spans(text: str, sizes: np.ndarray, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of each token. Tokens inside a character share its span."""
    ends = np.cumsum(sizes[ids])
    leads = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    character = np.cumsum(leads) - 1  # of each byte
    return character[ends - sizes[ids]], character[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "majority") -> np.ndarray:
    """The section of each token; section i is from ``bounds[i]`` up to ``bounds[i + 1]``, never empty."""
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    if rule == "start":
        return first
    if rule == "end":
        return last
    chosen = first.copy()
    for token in np.flatnonzero(first != last):  # few: tokens that cross a boundary
        parts = bounds[first[token]:last[token] + 2].clip(starts[token], ends[token])
        chosen[token] = first[token] + int(np.diff(parts).argmax())
    return chosen


def sections_of(values: list[str], split: int | None) -> tuple[str, list[tuple[int, int, int]]]:
    """The joined text and ``(field, section, first character)`` of what is not empty in it.

    A separator belongs to the field before it. Field number ``split`` has a section for each
    line, with its line end; any other field is one section.
    """
    found, at, last = [], 0, len(values) - 1
    for number, value in enumerate(values):
        whole = value if number == last else value + SEPARATOR
        parts = whole.split("\n") if number == split else [whole]
        for section, part in enumerate(parts):
            size = len(part) + (number == split and section < len(parts) - 1)
            if size:
                found.append((number, section, at))
                at += size
    return SEPARATOR.join(values), found


def count_tokens(
    docs: DataFrame, ranks: str, pattern: str, fields: tuple[str, ...], split: str | None = "text",
    key: str = "doc_id", rule: str = "majority",
) -> DataFrame:
    """``(key, field, section, start, chars, tokens)``: a row for each section with characters.

    ``fields`` are columns in the order in which they are joined; ``split`` names the one whose
    lines are sections. ``start`` and ``chars`` count characters of the joined text.

    NULL fields are empty and, but for their separator, have no section; a document without any
    character has no row. Repeated rows and NULL keys give rows of their own. An empty table
    gives an empty result. Other columns of ``docs`` are not read.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    names = [f"f{number}" for number in range(len(fields))]
    rows = docs.select(
        F.struct(F.col(quoted(key)).alias("key")).alias("_row"),
        *(F.col(quoted(field)).cast("string").alias(name) for field, name in zip(fields, names)))
    split_at = fields.index(split) if split is not None else None

    @F.pandas_udf("array<struct<field: int, section: int, start: long, chars: long, tokens: long>>")
    def counted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        coder, sizes = encoding(ranks, pattern)
        for columns in batches:
            results = []
            # A lone column comes as itself, not in a tuple.
            for values in zip(*((columns,) if isinstance(columns, pd.Series) else columns)):
                text, sections = sections_of([value or "" for value in values], split_at)
                if not sections:
                    results.append([])
                    continue
                ids = coder.encode_ordinary(text)
                bounds = np.array([start for _, _, start in sections] + [len(text)], np.int64)
                owners = attribute(*token_spans(text, sizes, ids), bounds, rule)
                tokens = np.bincount(owners, minlength=len(sections))
                results.append([
                    {"field": field, "section": section, "start": start, "chars": int(size), "tokens": int(count)}
                    for (field, section, start), size, count in zip(sections, np.diff(bounds), tokens)])
            yield pd.Series(results)

    text_batches(docs.sparkSession)
    labels = ", ".join("'" + field.replace("\\", "\\\\").replace("'", "\\'") + "'" for field in fields)
    return rows.select("_row", F.explode(counted(*names)).alias("s")).selectExpr(
        f"_row.key AS {quoted(key)}", f"array({labels})[s.field] AS field", "CAST(s.section AS BIGINT) AS section",
        "s.start AS start", "s.chars AS chars", "s.tokens AS tokens")
