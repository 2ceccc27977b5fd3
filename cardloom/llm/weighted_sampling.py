"""Document fingerprints by consistent weighted sampling.

For each of ``samples`` functions a term of weight S draws r, c ~ Gamma(2, 1) and b ~ U(0, 1),
all from the term's hash, and takes t = floor(ln S / r + b) and ln a = ln c - r (t - b) - r.
The pair (term, t) with the smallest a is the sample. Two documents agree on a sample with a
probability equal to their generalised Jaccard similarity: the sum of the smaller weights over
the sum of the larger ones. A term is a word, A-Z lower-cased; its weight is how often it occurs.

A fingerprint keeps eight bits of each sample; likeness corrects for chance agreement.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, shuffle_partitions, text_batches

SAMPLES = 128
TERMS = 2048  # terms that are drawn, or compared, at once
REMEMBERED = 1 << 16  # terms whose draws a worker keeps: 128 MB at 128 samples
CHARS = 1 << 18  # of texts fingerprinted together, so that they share the draws of their terms
RANGE_BYTES = 64 << 20
MAX_RANGES = 1 << 16  # bounds sent to every task: eight bytes each
_CHANCE = 1 / 256


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _uniforms(hashes: np.ndarray, samples: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1), of 24 bits each: a row for each hash, a column for each sample."""
    steps = (np.arange(samples, dtype=np.uint64) * np.uint64(8) + np.uint64(which + 1)) * np.uint64(0x9E3779B97F4A7C15)
    bits = _mix(hashes[:, None] + steps[None, :])
    parts = bits >> np.uint64(40), (bits >> np.uint64(16)) & np.uint64(0xFFFFFF)
    one, other = ((part.astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -24) for part in parts)
    return one, other


class Draws:
    """What terms draw, by row: r, ln c and b, for each sample."""

    def __init__(self, samples: int, rows: int):
        self.samples = samples
        self.r, self.log_c, self.b, self.once = (np.empty((rows, samples), np.float32) for _ in range(4))

    def fill(self, rows: np.ndarray, hashes: np.ndarray) -> None:
        for start in range(0, len(rows), TERMS):
            part, some = rows[start:start + TERMS], hashes[start:start + TERMS]
            r = -np.log(np.multiply(*_uniforms(some, self.samples, 0)))
            log_c = np.log(-np.log(np.multiply(*_uniforms(some, self.samples, 1))))
            b = _uniforms(some, self.samples, 2)[0]
            self.r[part], self.log_c[part], self.b[part] = r, log_c, b
            # Most terms occur once, and then t is 0.
            self.once[part] = log_c + r * b - r

    def log_a(self, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ln a of each term; the place of each in t, or -1; t of the terms that occur more than once."""
        value, place = self.once[rows], np.full(len(rows), -1)
        many = np.flatnonzero(weights > 1)
        place[many] = np.arange(len(many))
        at = rows[many]
        r, b = self.r[at], self.b[at]
        t = np.floor(np.log(weights[many]).astype(np.float32)[:, None] / r + b)
        value[many] = self.log_c[at] - r * (t - b) - r
        return value, place, t


class KnownDraws:
    """Draws of the terms met so far, REMEMBERED at most; when full, the half used most often stays."""

    def __init__(self, samples: int, room: int):
        self.draws, self.room = Draws(samples, room), room
        self.hashes, self.uses = np.zeros(room, np.uint64), np.zeros(room, np.int64)
        self.row: dict[int, int] = {}

    def rows_of(self, hashes: np.ndarray) -> np.ndarray:
        """The rows of ``room`` hashes at most, drawn now where they are new."""
        rows = np.fromiter((self.row.get(one, -1) for one in hashes.tolist()), np.int64, len(hashes))
        new = np.flatnonzero(rows < 0)
        if len(self.row) + len(new) > self.room:
            self._forget(rows[rows >= 0], max(0, self.room - len(new)))
            return self.rows_of(hashes)
        at = np.arange(len(self.row), len(self.row) + len(new))
        self.draws.fill(at, hashes[new])
        self.hashes[at], self.uses[at] = hashes[new], 0
        self.row.update(zip(hashes[new].tolist(), at.tolist()))
        rows[new] = at
        self.uses[rows] += 1
        return rows

    def _forget(self, wanted: np.ndarray, most: int) -> None:
        """Keep the rows ``wanted`` and the most used others, half of the room if ``most`` allows it."""
        held = len(self.row)
        self.uses[wanted] += held + self.uses[:held].max()
        kept = np.sort(np.argsort(-self.uses[:held], kind="stable")[:min(most, max(len(wanted), self.room // 2))])
        for table in (self.draws.r, self.draws.log_c, self.draws.b, self.draws.once, self.hashes, self.uses):
            table[:len(kept)] = table[kept]
        self.uses[:len(kept)] = np.minimum(self.uses[:len(kept)], 1 << 20) // 2
        self.row = dict(zip(self.hashes[:len(kept)].tolist(), range(len(kept))))


@lru_cache(maxsize=1)
def known_draws(samples: int, room: int) -> KnownDraws:
    """One per worker process."""
    return KnownDraws(samples, room)


def signatures(texts: list[bytes], samples: int = SAMPLES, remembered: int = REMEMBERED) -> np.ndarray:
    """A row of ``samples`` bytes for each text. A text without words has one term, the empty one.

    Of terms that tie in a, that with the smallest hash is taken, so a signature does not depend on
    the other texts.
    """
    import xxhash

    bags = [Counter(text.lower().split()) or Counter([b""]) for text in texts]
    terms = list(dict.fromkeys(term for bag in bags for term in bag))
    found = np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))
    order = np.argsort(found, kind="stable")
    hashes, rank = found[order], np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    place = dict(zip(terms, rank.tolist()))
    members, weights = [], []
    for bag in bags:  # the terms of each text, in order of their hashes
        at = np.fromiter((place[term] for term in bag), np.int64, len(bag))
        count = np.fromiter(bag.values(), np.float64, len(bag))
        sort = np.argsort(at)
        members.append(at[sort])
        weights.append(count[sort])
    best = np.full((len(texts), samples), np.inf, np.float32)
    winner, level = np.zeros((len(texts), samples), np.uint64), np.zeros((len(texts), samples), np.float32)
    columns, known = np.arange(samples), known_draws(samples, remembered)
    for start in range(0, len(hashes), remembered):  # once, unless texts are very rich in words
        rows = known.rows_of(hashes[start:start + remembered])
        for row, (at, counts) in enumerate(zip(members, weights)):
            low, high = np.searchsorted(at, (start, start + remembered))
            for first in range(low, high, TERMS):
                some = at[first:min(first + TERMS, high)]
                value, many, t = known.draws.log_a(rows[some - start], counts[first:first + len(some)])
                which = value.argmin(axis=0)
                least = value[which, columns]
                lower = least < best[row]
                np.copyto(best[row], least, where=lower)
                np.copyto(winner[row], hashes[some[which]], where=lower)
                # A term that occurs once has level 0; the others' levels are in ``t`` by their place in ``many``.
                levels = t[many[which], columns] if len(t) else np.float32(0)
                np.copyto(level[row], np.where(many[which] >= 0, levels, np.float32(0)), where=lower)
    kept = winner + level.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (_mix(kept + np.arange(samples, dtype=np.uint64)[None, :]) >> np.uint64(56)).astype(np.uint8)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated generalised Jaccard similarity of two fingerprints, 0 to 1."""
    agree = float((one == other).mean())
    return max(0.0, (agree - _CHANCE) / (1 - _CHANCE))


def edited_text(text: str, following: str) -> str:
    """The last half of the text, rounded down, replaced by as much of the following one's start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(docs: DataFrame, text: str, key: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows ``(_range, _ahead, _id, _text)``, sorted in their partitions by descending key.

    Each range of keys lies whole in one partition. Its last row, with ``_ahead`` set, is a copy
    of the first row of the range that follows, and after the last range of the first. Keys that
    tie are in order of their texts; NULL keys form the last range.
    """
    rows = docs.select(F.col(quoted(key)).cast("long").alias("_id"), F.expr(f"coalesce({quoted(text)}, '')").alias("_text"))
    size, missing = rows.selectExpr("coalesce(sum(octet_length(_text)), 0)", "count_if(_id IS NULL) > 0").first()
    ranges = max(1, min(MAX_RANGES, max(shuffle_partitions(docs.sparkSession), size // range_bytes)))
    shares = ", ".join(f"{i / ranges!r}D" for i in range(1, ranges))
    # The accuracy makes ranges even; their bounds are keys that occur, whatever the accuracy.
    found = rows.selectExpr("max(_id)", f"percentile_approx(_id, array({shares}), {max(10_000, 20 * ranges)})" if shares
                            else "array()").first()
    bounds = np.unique(np.array([*(found[1] or []), *([] if found[0] is None else [found[0]])], np.int64))
    last = len(bounds)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        # Range 0 has the largest keys; range ``last`` the NULLs.
        return pd.Series(np.searchsorted(-bounds[::-1], -ids.to_numpy(), side="right") - 1, dtype="int32")

    placed = rows.where("_id IS NOT NULL").select(
        range_of("_id").alias("_range"), F.lit(False).alias("_ahead"), "_id", "_text")
    firsts = docs.sparkSession.createDataFrame([(int(bound),) for bound in bounds], "_bound long")
    heads = rows.join(F.broadcast(firsts), F.expr("_id = _bound")).groupBy("_id").agg(F.min("_text").alias("_text"))
    heads = heads.select(range_of("_id").alias("_of"), "_id", "_text")
    total = last
    if missing:
        nulls = rows.where("_id IS NULL")
        placed = placed.union(nulls.selectExpr(f"{last} AS _range", "false AS _ahead", "_id", "_text"))
        heads = heads.union(nulls.selectExpr("_text").agg(F.min("_text").alias("_text")).selectExpr(
            f"{last} AS _of", "CAST(NULL AS BIGINT) AS _id", "_text"))
        total += 1
    total = max(1, total)
    ahead = heads.selectExpr(f"CAST(pmod(_of - 1, {total}) AS INT) AS _range", "true AS _ahead", "_id", "_text")
    return placed.union(ahead).repartitionById(total, F.col("_range")).sortWithinPartitions(
        "_range", "_ahead", F.desc_nulls_last("_id"), "_text")


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprints(
    docs: DataFrame, text: str = "text", key: str = "doc_id", samples: int = SAMPLES, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and both likenesses.

    The edited text is made with the next document in order of descending ``key`` (an integer);
    after the last comes the first, and a lone document follows itself. NULL texts count as
    empty; texts without words are alike. Keys that tie are ordered by text, NULL keys come
    last. Equal texts have equal fingerprints. An empty table gives an empty result. Other
    columns of ``docs`` are not read.
    """

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: tuple | None = None  # the row whose next one has not come yet, with its signature
        for rows in _portions(batches):
            pairs: list[tuple] = []  # a row, or None for the one that waited, and the row after it
            before = None if waiting is None else waiting[0]
            for at, (where, ahead, _, _) in enumerate(rows):
                if before is not None:
                    assert before == where, "a range ends with the first row of the next"
                    pairs.append((at - 1 if at else None, at))
                before = None if ahead else where
            texts = [row[3] for row in rows]
            changed = [edited_text(waiting[2] if one is None else texts[one], texts[at]) for one, at in pairs]
            # Texts and edited texts together: they share most terms.
            found = signatures([text.encode() for text in texts + changed], samples)
            docs_of = [waiting if one is None else (rows[one][0], rows[one][2], texts[one], found[one]) for one, _ in pairs]
            if pairs:
                new = found[len(texts):]
                yield pd.DataFrame({
                    "doc_id": pd.array([doc[1] for doc in docs_of], dtype="Int64"),
                    "n_chars": [len(doc[2]) for doc in docs_of],
                    "edited_sha256": [hashlib.sha256(one.encode()).hexdigest() for one in changed],
                    "fingerprint": [doc[3].tobytes().hex() for doc in docs_of],
                    "edited_fingerprint": [one.tobytes().hex() for one in new],
                    "near_edited": [likeness(doc[3], one) for doc, one in zip(docs_of, new)],
                    "near_next": [likeness(doc[3], found[at]) for doc, (_, at) in zip(docs_of, pairs)]})
            where, ahead, identity, content = rows[-1]
            waiting = None if ahead else (where, identity, content, found[len(rows) - 1])

    text_batches(docs.sparkSession)
    found = with_following(docs, text, key, range_bytes).mapInPandas(compare, RESULT)
    return found.withColumnRenamed("doc_id", key)


def _portions(batches: Iterable[pd.DataFrame]) -> Iterator[list[tuple]]:
    """Consecutive rows of about CHARS characters together."""
    for batch in batches:
        ids = batch["_id"].astype("Int64")
        rows, chars = [], 0
        for row in zip(batch["_range"], batch["_ahead"], ids, batch["_text"]):
            rows.append(row)
            chars += len(row[3])
            if chars >= CHARS:
                yield rows
                rows, chars = [], 0
        if rows:
            yield rows
