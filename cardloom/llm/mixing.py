"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash. One aggregate sums the words by source and hash bucket; running
sums inside a source find the bucket in which its budget ends. Only documents of that bucket
are summed again, by the next bits, until it holds one hash. A document is then taken by
comparing its hash with its source's threshold: nothing is sorted. A source that the mix
repeats has a budget for each pass over it, nested in the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, stage, unpacked, word_count

HASH_BITS = 60
LEVEL_BITS = 10
# Sources up to this number are sent to every task; beyond it the join shuffles.
BROADCAST_SOURCES = 100_000


def hash_of(key: str) -> str:
    """SQL: 60 bits of the key's md5 as BIGINT, which any engine can repeat. NULL hashes like ''."""
    return f"CAST(conv(substring(md5(coalesce(CAST({key} AS STRING), '')), 1, 15), 16, 10) AS BIGINT)"


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2
) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, size)``.

    Sources in code-point order, NULL last, weigh ``weights``, repeating, and share ``share``
    times all words. No target exceeds ``repeats`` times its source; the excess goes to the
    others by weight. A source is capped if its cap is less than its share of what sources
    with a lower ratio of cap to weight leave, so one pass in that order finds all of them.
    The windows run over one row per source.
    """
    cases = " ".join(f"WHEN {i} THEN {float(weight)!r}D" for i, weight in enumerate(weights))
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = by_source.selectExpr(
        "source", "source_size",
        "row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place",
    ).selectExpr("source", "source_size", "place", f"CASE place % {len(weights)} {cases} END AS weight",
                 f"CAST({repeats} * source_size AS DOUBLE) AS cap")
    before = "OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ranked = weighed.selectExpr(
        "*", f"{share!r}D * CAST(sum(source_size) OVER () AS DOUBLE) AS total", "sum(weight) OVER () AS weights",
        f"coalesce(sum(cap) {before}, 0D) AS cap_before", f"coalesce(sum(weight) {before}, 0D) AS weight_before",
    ).selectExpr("*", "cap * (weights - weight_before) <= (total - cap_before) * weight AS capped")
    summed = ranked.selectExpr(
        "*", "coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0D) AS cap_sum",
        "weights - coalesce(sum(CASE WHEN capped THEN weight END) OVER (), 0D) AS weight_left")
    return summed.selectExpr(
        "source", "source_size", "CASE WHEN capped THEN cap ELSE (total - cap_sum) * weight / weight_left END AS target")


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``passes`` taken whole, then hashes below ``limit``, then ``rest`` words at it.

    ``sizes(source, size, hash)``; ``at_limit`` is the number of words at the limit.
    """
    budgets = stage(targets.selectExpr(
        "*", "CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS INT) ELSE 0 END AS passes",
    ).selectExpr("*", "CAST(floor(target) AS BIGINT) - passes * source_size AS budget"), "mix-budgets")
    # The part of a source that its budget ends in: at first all of it.
    part = budgets.where("budget > 0").selectExpr("source AS of", "budget AS rest", "0L AS prefix")
    inside, limits = sizes, None
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        inside = inside.join(_few(part), F.expr(
            f"source <=> of AND shiftright(hash, {shift + LEVEL_BITS}) = prefix")).select(
                "source", "size", "hash", "rest")
        if level > 1:
            inside = stage(inside, "mix-bucket")
        buckets = inside.groupBy("source", F.expr(f"shiftright(hash, {shift}) AS prefix")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high"),
            F.first("rest").alias("rest"))
        running = buckets.selectExpr(
            "*", "sum(words) OVER (PARTITION BY source ORDER BY prefix) - words AS before",
        ).where("before <= rest AND rest < before + words")
        limits = stage(running.selectExpr(
            "source AS of", "rest - before AS rest", "prefix", "words AS at_limit", "low", "high"), "mix-limits")
        if limits.where("low <> high").isEmpty():
            break
        inside, part = inside.drop("rest"), limits.select("of", "rest", "prefix")
    return budgets.join(limits.selectExpr("of", "low AS limit", "rest", "at_limit"), F.expr("source <=> of"), "left").drop("of")


def _few(by_source: DataFrame) -> DataFrame:
    """Broadcast a table of one row per source if it is small enough, else leave the join to Spark."""
    return F.broadcast(by_source) if by_source.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else by_source


def mix(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2,
    whole: bool = False, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` words.

    The document at a source's threshold is taken in part, so that the source's words add up
    to the target rounded down; with ``whole`` it is taken if at least half of it is wanted.
    ``keep`` names the input columns to return, all by default.

    A NULL or empty text has size 0 and nothing is taken of it. A NULL source is a source, the
    last one. Rows that repeat a key have the same hash and share what is taken at the limit in
    proportion. If no text has words all targets are 0. An empty table gives an empty result.
    Columns named like a result are replaced.
    """
    columns = docs.columns if keep is None else list(keep)
    rows = docs.select(
        F.struct(*(F.col(quoted(name)) for name in columns)).alias("_row"),
        F.col(quoted(source)).alias("source"), F.expr(word_count(quoted(text))).alias("size"),
        F.expr(hash_of(quoted(key))).alias("hash"))
    # Sizes are counted once where no text has to come along; else the second scan counts again.
    carries_text = text in columns
    sizes = stage(rows.select(*([] if carries_text else ["_row"]), "source", "size", "hash"), "mix-sizes")
    limits = stage(thresholds(sizes.select("source", "size", "hash"),
                              source_targets(sizes, weights, share, repeats)), "mix-thresholds")
    placed = (rows if carries_text else sizes).join(
        _few(limits.withColumnRenamed("source", "of")), F.expr("source <=> of"))
    at_limit = "CASE WHEN 2 * rest >= at_limit THEN size ELSE 0 END" if whole else "(size * rest) DIV at_limit"
    return unpacked(
        placed, columns, size="size", source_size="source_size", target="target",
        taken=f"passes * size + CASE WHEN hash < limit THEN size WHEN hash = limit THEN {at_limit} ELSE 0 END")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix themselves: each row as often as it is taken, whole, or not at all."""
    names = docs.columns
    whole = docs.select(F.struct(*(F.col(quoted(name)) for name in names)).alias("_doc"), *(
        F.col(quoted(options.get(role, name))).alias(f"_{role}")
        for role, name in (("text", "text"), ("key", "doc_id"), ("source", "source"))))
    taken = mix(whole, **{**options, "text": "_text", "key": "_key", "source": "_source"}, whole=True)
    copies = taken.selectExpr("_doc", "explode(array_repeat(0, CAST(taken DIV greatest(size, 1) AS INT))) AS copy")
    return copies.select("_doc.*")
