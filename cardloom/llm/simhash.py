"""SimHash near-duplicates: pigeonhole blocks, join on blocks, verify the bit distance.

Fingerprints are cut into ``k`` blocks. Two that differ in at most ``d`` bits agree on
``k - d`` of the blocks, so for each choice of ``k - d`` blocks a table keyed by their bits
puts every close pair together at least once. Only distinct fingerprints enter the tables.
A task compares the fingerprints of a key and returns a star per component found, not pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, stage, text_batches
from cardloom.llm.components import connected_components

BITS = 64
# A key with more fingerprints than this is compared in tiles: each pair of its chunks, of
# half this many each, goes to a task. No pair is left out, and no task holds more.
TILE = 8192
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """SimHash of the word shingles, repeats included; without words zero."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and just the six ASCII white-space characters
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([digest(joined, seed)], dtype=np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - shingle + 1)
    # Eight counters at a time in the bytes of one word; 255 additions cannot overflow a byte.
    edges = np.arange(0, len(hashes), 255)
    ones = np.empty(BITS, np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, edges)
        ones[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` and ``_fp``, the fingerprint as a signed BIGINT. NULL text counts as empty."""

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter(
                (fingerprint(text.encode(), shingle, seed) if text else 0 for text in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    text_batches(docs.sparkSession)
    return docs.withColumn("_fp", fingerprints(F.col(quoted(text))))


def block_masks(blocks: int, distance: int) -> list[int]:
    """One mask for each choice of ``blocks - distance`` blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << (high - low)) - 1) << low for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in itertools.combinations(parts, blocks - distance)]


def choose_blocks(count: int, distance: int) -> int:
    """The number of blocks with the least work for so many fingerprints; any number is exact.

    More blocks give more tables, to be shuffled, with longer keys and so fewer comparisons.
    """
    def work(blocks: int) -> float:
        key_bits = BITS * (blocks - distance) / blocks
        return math.comb(blocks, distance) * count * (1000 + count / 2 ** key_bits)

    return min(range(distance + 1, distance + 7), key=work)


def star_links(values: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """(member, smallest member) for each component among distinct fingerprints."""
    left = np.sort(values)
    bits = left.view(np.uint64)
    while len(left) > 1:
        root, frontier = left[0], [bits[0]]
        left, bits = left[1:], bits[1:]
        while frontier and len(left):
            near = np.bitwise_count(bits ^ frontier.pop()) <= distance
            if near.any():
                frontier.extend(bits[near])
                yield from ((member, root) for member in left[near].tolist())
                left, bits = left[~near], bits[~near]


def close_links(fingerprints: DataFrame, distance: int, count: int, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that join the same components as all pairs within ``distance`` do.

    ``fingerprints`` has distinct values in ``_fp``; ``count`` is their number.
    """
    masks = block_masks(choose_blocks(count, distance), distance)
    # The sign bit makes literals of the upper half awkward in SQL: write them as signed.
    signed = [mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask for mask in masks]
    tables = ", ".join(f"struct({number} AS no, _fp & ({mask}L) AS bits)" for number, mask in enumerate(signed))
    placed = fingerprints.selectExpr("_fp", f"explode(array({tables})) AS place").selectExpr(
        "_fp", "place.no AS no", "place.bits AS bits")
    sizes = placed.groupBy("no", "bits").agg(F.count("*").alias("size"))
    crowded = stage(sizes.where(F.col("size") > tile), "crowded-blocks")
    if not crowded.isEmpty():
        placed = placed.join(crowded, ["no", "bits"], "left").selectExpr(
            "_fp", "no", "bits", f"CAST(ceil(coalesce(size, 1) / {max(1, tile // 2)}) AS INT) AS chunks",
        ).selectExpr("*", "CAST(pmod(xxhash64(_fp), chunks) AS INT) AS chunk").selectExpr(
            "_fp", "no", "bits", "chunk", "explode(sequence(0, chunks - 1)) AS other",
        ).selectExpr("_fp", "no", "bits", "least(chunk, other) AS low", "greatest(chunk, other) AS high")
    else:
        placed = placed.selectExpr("_fp", "no", "bits", "0 AS low", "0 AS high")
    keys = ["no", "bits", "low", "high"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if rest is None or not len(rest):
                continue
            place = rest[keys].to_numpy()
            cuts = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            # The last key may go on in the next batch.
            done = len(rest) if batch is None else (cuts[-1] if len(cuts) else 0)
            values, found = rest["_fp"].to_numpy(), []
            edges = [0, *cuts[cuts < done].tolist(), done]
            for start, end in zip(edges, edges[1:]):
                if end - start > 1:
                    found.extend(star_links(values[start:end], distance))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
            rest = rest.iloc[done:].reset_index(drop=True)

    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(compare, "a long, b long")


def components_of(rows: DataFrame, distance: int, tile: int = TILE) -> DataFrame:
    """``(_fp, root, component_id)`` for ``rows(_id, _fp)``.

    ``root`` is the smallest fingerprint in reach, ``component_id`` the smallest id.
    """
    known = stage(rows.groupBy("_fp").agg(F.min("_id").alias("_id")), "fingerprints")
    links = close_links(known.select("_fp"), distance, known.count(), tile)
    roots = stage(connected_components(links), "components")
    joined = known.join(roots, F.col("_fp") == F.col("node"), "left").selectExpr(
        "_fp", "_id", "coalesce(root, _fp) AS root")
    lowest = joined.groupBy("root").agg(F.min("_id").alias("component_id"))
    return joined.join(lowest, "root").select("_fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 4, distance: int = 4, seed: int = 42,
    tile: int = TILE,
) -> DataFrame:
    """``(key, fingerprint, component_id)`` for each row of ``docs``.

    Fingerprints that differ in at most ``distance`` bits are linked; ``component_id`` is the
    smallest key in reach. Texts without words, NULL among them, have fingerprint zero and are
    linked like any other. Repeated rows each give a row. NULL keys are no candidates for
    ``component_id``, which is NULL where a component has no other. An empty table gives an
    empty result. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(quoted(key)).alias("_id"), F.col(quoted(text)).alias("_text"))
    rows = stage(with_fingerprint(rows, "_text", shingle, seed).select("_id", "_fp"), "simhash")
    return rows.join(components_of(rows, distance, tile), "_fp").selectExpr(
        f"_id AS {quoted(key)}", "lpad(lower(hex(_fp)), 16, '0') AS fingerprint", "component_id")


def one_of_each(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 4, distance: int = 4, seed: int = 42,
    tile: int = TILE,
) -> DataFrame:
    """The rows of ``docs``, all columns, but one row only of each component: that of the smallest key.

    Of rows that tie in the key, that with the smallest hash of its text stays, so the choice
    is repeatable; of identical rows one stays. A component whose keys are all NULL keeps one.
    """
    names = docs.columns
    whole = docs.select(F.struct(*(F.col(quoted(name)) for name in names)).alias("_row"))
    whole = whole.selectExpr("_row", f"_row.{quoted(key)} AS _id", f"_row.{quoted(text)} AS _text").selectExpr(
        "*", "xxhash64(_text) AS _check")
    rows = stage(with_fingerprint(whole, "_text", shingle, seed).select("_id", "_check", "_fp"), "simhash")
    classed = rows.join(components_of(rows, distance, tile), "_fp")
    chosen = classed.groupBy("root").agg(F.expr("min(struct(_id IS NULL AS missing, _id, _check)) AS best"))
    chosen = chosen.selectExpr("best._id AS id", "best._check AS chk").distinct()
    kept = whole.join(chosen, F.expr("_id <=> id AND _check = chk"))
    return kept.dropDuplicates(["_id", "_check"]).select("_row.*")
