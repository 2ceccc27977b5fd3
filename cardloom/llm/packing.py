"""Packing of token ids into sequences: first-fit decreasing in randomised groups.

Documents are dealt into groups of like size by a hash. Inside a group a document longer than
a sequence is cut, and first-fit decreasing puts the pieces into bins; a tournament tree over
the room left in each bin finds the first bin that fits in logarithmic time. Room that is
left over is then filled by cutting up the emptiest bins, and the one bin that stays short is
laid out as sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, text_batches
from cardloom.llm.tokens import encoder

LENGTH = 4096
END = 2
GROUP_BYTES = 4 << 20  # of text: what a task holds at once; its last bin is all that may stay short
SEQUENCES = 1 << 24  # numbers kept free for the sequences of a group

PIECES = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")

Part = tuple[int, int, int]  # document (its place in the group), start, length


class FirstFit:
    """Bins in a tournament tree: each inner node knows the most room below it."""

    def __init__(self, bins: int, length: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [length] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put ``size`` into the first bin with room for it."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return found


def pack_group(sizes: list[int], length: int = LENGTH) -> list[list[Part]]:
    """Sequences of ``(document, start, length)`` for documents of these sizes."""
    bins: list[list[Part]] = []
    tails: list[Part] = []
    for doc, size in enumerate(sizes):
        whole = size - size % length
        bins.extend([(doc, start, length)] for start in range(0, whole, length))
        if size > whole:
            tails.append((doc, whole, size - whole))
    tails.sort(key=lambda part: (-part[2], part[0]))
    tree, open_bins = FirstFit(len(tails), length), []
    for part in tails:
        at = tree.place(part[2])
        if at == len(open_bins):
            open_bins.append([])
        open_bins[at].append(part)
    filled, short = _fill(open_bins, length)
    return bins + filled + _powers(short)


def _fill(bins: list[list[Part]], length: int) -> tuple[list[list[Part]], list[Part]]:
    """Full bins, and what is left for one short bin."""
    waiting = [(length - sum(part[2] for part in parts), parts) for parts in bins]
    waiting.sort(key=lambda entry: entry[0])  # fullest first; the emptiest give
    full, low, high, spare = [], 0, len(waiting) - 1, []
    while low <= high:
        room, parts = waiting[low]
        parts = list(parts)
        while room:
            if not spare:
                if high == low:
                    return full, parts
                spare = list(waiting[high][1])
                high -= 1
            doc, start, size = spare.pop()
            take = min(size, room)
            parts.append((doc, start, take))
            room -= take
            if size > take:
                spare.append((doc, start + take, size - take))
        full.append(parts)
        low += 1
    # What the last giver has left would have been a bin of its own.
    return full, spare


def _powers(parts: list[Part]) -> list[list[Part]]:
    """The parts laid end to end and cut into sequences of powers of two, largest first."""
    rest, found = sum(part[2] for part in parts), []
    parts = list(reversed(parts))
    while rest:
        room = 1 << (rest.bit_length() - 1)
        rest -= room
        sequence: list[Part] = []
        while room:
            doc, start, size = parts.pop()
            take = min(size, room)
            sequence.append((doc, start, take))
            room -= take
            if size > take:
                parts.append((doc, start + take, size - take))
        found.append(sequence)
    return found


def with_token_ids(docs: DataFrame, tokenizer: str, text: str = "text", end: int | None = END) -> DataFrame:
    """``docs`` and ``_ids``: the packed ids of the text, then ``end`` if given."""

    @F.pandas_udf("binary")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = encoder(tokenizer)
        closing = b"" if end is None else np.array([end], dtype=ids.dtype).tobytes()
        for texts in batches:
            yield pd.Series([ids.encode(text) + closing for text in texts])

    text_batches(docs.sparkSession)
    return docs.withColumn("_ids", ids_of(F.col(quoted(text))))


def pack(
    docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", length: int = LENGTH, end: int = END,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's; sequences
    are full or a power of two long, so none needs padding. A NULL or empty text is the end id
    alone. Repeated rows and NULL keys are documents of their own, each packed. An empty table
    gives no pieces. Other columns of ``docs`` are not read.

    The result depends on the rows alone, not on their order or partitions, except for which of
    several identical rows is which.
    """
    id_type = docs.select(F.col(quoted(key))).schema[0].dataType.simpleString()
    # pandas has no missing integers: a NULL key travels as a flag beside a zero.
    rows = docs.select(F.col(quoted(key)).alias("_id"), F.col(quoted(text)).alias("_text")).selectExpr(
        "_id IS NULL AS _missing", f"coalesce(_id, CAST(0 AS {id_type})) AS _id", "_text")
    total = rows.selectExpr("coalesce(sum(octet_length(_text)), 0) + 8 * count(*)").first()[0]
    groups = max(1, -(-total // group_bytes))
    dealt = with_token_ids(rows, tokenizer, "_text", end).selectExpr(
        "_missing", "_id", "_ids", f"pmod(xxhash64(_missing, _id, _text, 'pack'), {groups}L) AS _group")

    def pieces(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_missing", "_id", "_ids"], kind="stable")
        dtype, ids, keys = encoder(tokenizer).dtype, frame["_ids"].tolist(), frame[["_missing", "_id"]].to_records(index=False).tolist()
        first, found = int(frame["_group"].iloc[0]) * SEQUENCES, []
        sizes = [len(packed) // dtype.itemsize for packed in ids]
        for number, sequence in enumerate(pack_group(sizes, length)):
            offset = 0
            for doc, start, size in sequence:
                part = np.frombuffer(ids[doc], dtype, size, start * dtype.itemsize).astype("<u4")
                found.append((*keys[doc], start, size, zlib.crc32(part.tobytes()), sizes[doc], first + number, offset))
                offset += size
        return pd.DataFrame(found, columns=[
            "_missing", "_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    packed = dealt.groupBy("_group").applyInPandas(pieces, f"_missing boolean, _id {id_type}, {PIECES}")
    return packed.selectExpr(f"CASE WHEN NOT _missing THEN _id END AS {quoted(key)}", *packed.columns[2:])
