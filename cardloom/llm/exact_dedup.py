"""Exact de-duplication over an extendible-hash index on shared files.

1. One scan sums bytes and rows by the 64-bit key of the text. The sums are written to the
   shared folder: they are all that the directory is made from.
2. The directory starts as one bucket. It doubles level by level; at each level only buckets
   above the capacity split, by the next bit of the key. All levels come from one aggregate.
3. Every text goes to the task that owns its bucket, a range of keys. A key that alone
   exceeds a bucket has overflow pages, each with an owner of its own.
4. The owner sorts its page by key and text and so compares the bytes of all texts that share
   a key; different texts under one key form the links of a chain. Its rows are written.
5. The heads of overflow pages, and they alone, meet once more to join equal texts.

DataFrame and SQL functions only. Texts are shuffled once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import ascii_lower, quoted, shuffle_partitions, stage, unpacked

BUCKET_BYTES = 64 << 20
# The directory and the list of overfull keys are broadcast. Both have at most this many
# entries of a few numbers each: buckets are made larger rather than more.
MAX_ENTRIES = 1 << 18
TEXT_KEY = "xxhash64(lower({}))"


def exact_dedup(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: list[str] | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    text_key: str = TEXT_KEY,
) -> DataFrame:
    """Every row of ``docs`` with the class of its text; dropped rows too.

    Texts are equal if identical after lower-casing A-Z. Adds ``keep_id`` (the largest key of
    the class), ``group_size``, ``kept`` and ``text_sha256`` (of the lower-cased text).
    ``keep`` names the input columns to return, all by default.

    NULL text counts as empty, and empty texts are a class. A NULL key is below all others;
    a class that has only such rows has a NULL ``keep_id`` and still keeps one row. Of rows
    that repeat key and text exactly one is kept. An empty table gives an empty result. Other
    columns pass through; those named like a result are replaced.

    ``text_key`` must be equal for equal texts; that it is coarser than needed costs time only.
    """
    columns = docs.columns if keep is None else list(keep)
    rest = [name for name in columns if name != text]
    source = docs.select(
        F.struct(*(F.col(quoted(name)) for name in rest or [key])).alias("_row"),
        F.col(quoted(key)).alias("_id"), F.col(quoted(text)).alias("_text"),
    ).selectExpr("*", f"{text_key.format("coalesce(_text, '')")} AS _key")

    loads = stage(key_loads(source), "dedup-keys")
    total = loads.selectExpr("coalesce(sum(load), 0)").first()[0]
    capacity = bucket_capacity(total, shuffle_partitions(docs.sparkSession), bucket_bytes)
    pages = stage(overflow_pages(loads, capacity), "dedup-pages")
    entries = stage(directory(loads, capacity, total), "dedup-directory")
    owners = 1 + max(part.selectExpr("coalesce(max(owner), 0)").first()[0] for part in (
        entries, pages.selectExpr("first_owner + pages - 1 AS owner")))

    index = stage(owned_pages(source, entries, pages, owners, text if text in columns else None), "dedup-index")
    result = across_pages(index)
    if text in columns:
        result = result.withColumn("_row", F.struct(
            *(F.col("_text").alias(text) if name == text else F.col("_row")[name].alias(name) for name in columns)))
    return unpacked(result, columns, keep_id="_keep", group_size="_size", kept="_kept", text_sha256="_sha")


def distinct_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that stay."""
    names = docs.columns
    held = docs.select(
        F.struct(*(F.col(quoted(name)) for name in names if name != text)).alias("_held"),
        F.col(quoted(key)).alias("_held_key"), F.col(quoted(text)).alias("_held_text"))
    kept = exact_dedup(held, "_held_text", "_held_key", keep=["_held", "_held_text"]).where("kept")
    return kept.select(*(
        F.col("_held_text").alias(text) if name == text else F.col("_held")[name].alias(name) for name in names))


def key_loads(source: DataFrame) -> DataFrame:
    """Bytes of text by key; combined before the shuffle. A row counts 16 bytes besides its text."""
    return source.groupBy("_key").agg(F.expr("sum(16 + octet_length(coalesce(_text, '')))").alias("load"))


def bucket_capacity(total: int, partitions: int, bucket_bytes: int) -> int:
    """Bytes a bucket may hold: at least two buckets a task slot, and no more than MAX_ENTRIES."""
    return max(1, min(bucket_bytes, total // (2 * partitions)), 4 * total // MAX_ENTRIES)


def overflow_pages(loads: DataFrame, capacity: int) -> DataFrame:
    """Keys that exceed a bucket alone: ``(key, pages, first_owner)``.

    The loads of these keys add up to the total at most, so there are fewer than
    ``total / capacity`` of them, and the window below stays within MAX_ENTRIES rows.
    """
    return loads.where(F.col("load") > capacity).selectExpr(
        "_key AS key", f"CAST(ceil(load / {capacity}) AS INT) AS pages"
    ).selectExpr(
        "key", "pages",
        "CAST(sum(pages) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - pages AS INT)"
        " AS first_owner",
    )


def directory(loads: DataFrame, capacity: int, total: int) -> DataFrame:
    """The directory at its final depth: ``(entry, shift, depth, bucket, owner)``.

    ``entry`` is a key's leading bits, ``key >>> shift``. Several entries point to one bucket
    when that bucket has split less often than the directory has doubled.
    """
    bits = min(MAX_ENTRIES.bit_length() - 1, max(1, math.ceil(math.log2(max(2.0, total / capacity))) + 3))
    shift = 64 - bits
    cells = loads.where(F.col("load") <= capacity).groupBy(
        F.expr(f"shiftrightunsigned(_key, {shift})").alias("entry")).agg(F.sum("load").alias("load"))
    levels = cells.selectExpr("entry", "load", f"explode(sequence(0, {bits})) AS depth").selectExpr(
        "*", f"shiftright(entry, {bits} - depth) AS bucket")
    filled = levels.groupBy("depth", "bucket").agg(F.sum("load").alias("filled"))
    # A bucket splits while it is overfull: an entry points to the first level where it is not.
    settled = levels.join(filled, ["depth", "bucket"]).where(f"filled <= {capacity} OR depth = {bits}").groupBy(
        "entry").agg(F.min(F.struct("depth", "bucket")).alias("at"))
    return settled.selectExpr("entry", f"{shift} AS shift", "at.depth", "at.bucket").selectExpr(
        "*", f"CAST(dense_rank() OVER (ORDER BY shiftleft(bucket, {bits} - depth)) - 1 AS INT) AS owner")


def owned_pages(
    source: DataFrame, entries: DataFrame, pages: DataFrame, owners: int, text: str | None
) -> DataFrame:
    """Send each row to the owner of its bucket or page, and compare the texts there.

    Rows of overfull keys are dealt over pages by a hash of the row's key.
    """
    shift = (entries.select("shift").first() or (63,))[0]
    placed = source.join(F.broadcast(entries.selectExpr("entry AS _entry", "owner AS _bucket")),
                         F.expr(f"_entry = shiftrightunsigned(_key, {shift})"), "left")
    placed = placed.join(F.broadcast(pages), F.col("_key") == F.col("key"), "left").selectExpr(
        "_row", "_id", "_text", "_key", "coalesce(pages, 1) AS _pages",
        "CASE WHEN pages IS NULL THEN 0 ELSE CAST(pmod(xxhash64(_id, 'page'), pages) AS INT) END AS _page",
        "first_owner", "_bucket",
    ).selectExpr(
        "_row", "_id", "_text", "_key", "_pages", "_page",
        # Pages take the numbers from 0 as well: an owner may hold a bucket and a page.
        "CAST(coalesce(first_owner + _page, _bucket, 0) AS INT) AS _owner",
    ).repartitionById(owners, F.col("_owner"))
    chained = placed.selectExpr("*", f"{ascii_lower("coalesce(_text, '')")} AS _norm")
    same = "PARTITION BY _owner, _key, _page, _norm"
    return chained.selectExpr(
        "_row", *(["_text"] if text else []), "_key", "_page", "_pages", "sha2(_norm, 256) AS _sha",
        f"max(_id) OVER ({same}) AS _keep",
        f"count(*) OVER ({same}) AS _size",
        f"row_number() OVER ({same} ORDER BY _id DESC NULLS LAST) = 1 AS _head",
        f"CASE WHEN _pages > 1 AND row_number() OVER ({same} ORDER BY _id DESC NULLS LAST) = 1 THEN _norm END AS _norm",
    )


def across_pages(index: DataFrame) -> DataFrame:
    """Join what equal texts on several pages of a key have found; other rows are final."""
    heads = index.where("_pages > 1 AND _head").selectExpr(
        "_key AS key", "_page AS page", "_sha AS sha",
        "max(_keep) OVER (PARTITION BY _key, _norm) AS keep",
        "sum(_size) OVER (PARTITION BY _key, _norm) AS size",
        "row_number() OVER (PARTITION BY _key, _norm ORDER BY _keep DESC NULLS LAST, _page) = 1 AS leads",
    )
    found = index.join(
        heads, F.expr("_pages > 1 AND _key = key AND _page = page AND _sha = sha"), "left")
    columns = [name for name in index.columns if name in ("_row", "_text", "_sha")]
    return found.selectExpr(
        *columns,
        "CASE WHEN _pages > 1 THEN keep ELSE _keep END AS _keep",
        "CASE WHEN _pages > 1 THEN size ELSE _size END AS _size",
        "_head AND (_pages = 1 OR leads) AS _kept",
    )
