"""N-gram Jaccard join: rare-first prefixes, filtered and verified once per pair.

A document's set holds its distinct word shingles. Two sets whose Jaccard similarity reaches the
threshold t share one of the first ``|x| - ceil(t |x|) + 1`` tokens of each, in any order of all tokens
that both use. Rare tokens come first here. How common a token is, is counted over all documents in
BUCKETS buckets of its hash: a table of fixed size, which sees the frequent ones.

1. Equal sets become one representative, so copies cost nothing further.
2. Prefix tokens are shuffled; those with one representative only go.
3. Anchor rounds: of the sets that have the same smallest hash of a token, each meets one, the anchor, and
   those that are linked to it leave the rounds. This joins groups of near copies without comparing all
   pairs of them, and decides nothing else. Rounds go on while they find many links.
4. All pairs are due that share a token and are not connected yet. The length filter and the positional
   filter (at the first common token, what may follow must suffice) need sizes and places only. Rows of a
   token that many have bring a short sketch along (see 5), so that a pair of them leaves its task only if
   this allows it. Before all pairs, such a row meets its NEAREST by the sketches, in rounds like those
   of the anchors: what this connects is not compared again. It decides nothing else.
5. The suffix filter bounds the number of differing tokens from below by bit sketches: one bit for
   each of many cells says if the cell has an odd number of tokens, and each differing token
   flips one. The tokens before the first match differ anyway, so the bound is that of the suffixes.
6. Pairs that remain are verified by their whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import by_key, quoted, stage, text_batches
from cardloom.llm.components import connected_components

BUCKETS = 1 << 16  # counts of how common tokens are: half a megabyte for every task
MARKS = 8  # anchor rounds at most
CHUNK = 4096  # members of a token, or of a mark, that one task has at once
PAIRS = 1 << 20  # pairs that a task holds before the filters
CROWD = 32  # rows of a token from which they bring sketches
ROUNDS = 6  # of the nearest at most
NEAREST = 4  # partners of a row and a crowded token before all pairs are compared
WORDS = 32  # 64-bit words of a sketch that is brought along, at most
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; of a shorter text the whole sequence."""
    import xxhash

    words = text.encode().lower().split() if text else []  # bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    count = len(words) - span + 1
    mixed = np.full(count, span, np.uint64)
    for at in range(span):
        mixed = (mixed * _ODD) ^ hashes[at:at + count]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(_mix(mixed))


def needed(size, other, percent: int):
    """The least number of common tokens with which two sets of these sizes reach the threshold."""
    return -(-percent * (size + other) // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens in each of 64 times a power of two cells, about two cells per token."""
    cells = 64
    while cells < 2 * len(tokens):
        cells *= 2
    counts = np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(one: bytes, other: bytes) -> int:
    """A lower bound of the number of tokens that are in one of two sets only."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    while len(a) != len(b):  # half the cells: cell i and cell i + half become one
        if len(a) > len(b):
            a = a[:len(a) // 2] ^ a[len(a) // 2:]
        else:
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def folded(bits: bytes, words: int = WORDS) -> bytes:
    """A sketch with at most ``words`` words, a power of two; it bounds the difference from below, too."""
    cells = np.frombuffer(bits, np.uint64)
    while len(cells) > words:
        cells = cells[:len(cells) // 2] ^ cells[len(cells) // 2:]
    return cells.tobytes()


def least_differences(sketches: list[bytes | None], one: np.ndarray, two: np.ndarray, held: int = 1 << 15) -> np.ndarray:
    """``least_difference`` of each two of the sketches, given by their numbers; -1 if one of the two is missing.

    ``held`` pairs are worked on at once.
    """
    width = np.array([len(bits) // 8 if bits is not None else 0 for bits in sketches], np.int64)
    common = np.minimum(width[one], width[two])
    found = np.full(len(one), -1, np.int64)
    cells = np.zeros((0, 0), np.uint64)
    for words in sorted({*width.tolist()} - {0}, reverse=True):
        wider, cells = cells, np.zeros((len(sketches), words), np.uint64)
        if len(wider):
            while wider.shape[1] > words:
                wider = wider[:, :wider.shape[1] // 2] ^ wider[:, wider.shape[1] // 2:]
            cells ^= wider
        for row in np.flatnonzero(width == words):
            cells[row] = np.frombuffer(sketches[row], np.uint64)
        due = np.flatnonzero(common == words)
        for start in range(0, len(due), held):
            some = due[start:start + held]
            found[some] = np.bitwise_count(cells[one[some]] ^ cells[two[some]]).sum(axis=1)
    return found


def rank(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The place of each value among those of its group, from 0."""
    order = np.lexsort((value, group))
    ordered, found = group[order], np.empty(len(group), np.int64)
    found[order] = np.arange(len(group)) - np.searchsorted(ordered, ordered)
    return found


def marks_of(tokens: np.ndarray) -> np.ndarray:
    """The smallest value of each of MARKS hashes over the tokens: sets agree on each as often as they are similar."""
    return np.array([_mix(tokens ^ (_ODD * np.uint64(seed))).min() for seed in range(1, MARKS + 1)], np.uint64)


def common_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many shingles of all documents (``_text``) fall into each bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["_text"]:
                held += np.bincount(shingles(text, width) >> np.uint64(48), minlength=BUCKETS)
        some = np.flatnonzero(held)
        yield pd.DataFrame({"bucket": some, "n": held[some]})

    rows = docs.select("_text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(BUCKETS, np.int64)
    for row in rows.collect():  # BUCKETS rows at most
        found[row.bucket] = row.n
    return found


def token_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(_id, size, node, prefix, bits, marks)`` for each row ``(_id, _text)``; equal sets have equal nodes."""
    counts = common_counts(docs, width)

    @F.pandas_udf("size int, node binary, prefix array<long>, bits binary, marks array<long>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                tokens = shingles(text, width)
                first = prefix_length(len(tokens), percent) if len(tokens) else 0
                common = counts[tokens >> np.uint64(48)]
                prefix = tokens[np.lexsort((tokens, common))[:first]]
                marks = marks_of(tokens).view(np.int64) if len(tokens) else None
                rows.append((len(tokens), hashlib.md5(tokens.tobytes()).digest(), prefix.view(np.int64), sketch(tokens), marks))
            yield pd.DataFrame(rows, columns=["size", "node", "prefix", "bits", "marks"])

    return docs.withColumn("_set", describe("_text")).select("_id", "_set.*")


def shared_prefixes(reps: DataFrame) -> DataFrame:
    """``(token, rep, size, pos, load)``: prefix tokens that ``load`` representatives, two or more, have in their prefix."""
    # One shuffle of the places; the count of a token is a frame over its sorted rows, which may spill.
    places = reps.selectExpr("rep", "size", "posexplode(prefix) AS (pos, token)")
    return places.selectExpr("*", "count(*) OVER (PARTITION BY token) AS load").where("load > 1")


def anchor_pairs(reps: DataFrame, percent: int, number: int, chunk: int = CHUNK) -> DataFrame:
    """Candidates ``(a, b)``: representatives and the anchor of those with the same mark, one each, within the length limit.

    A mark of many is dealt to chunks with an anchor each; rows are read as a stream.
    """
    marked = reps.selectExpr("rep", "size", f"marks[{number}] AS mark", f"xxhash64(rep, {number}) AS turn")
    heavy = marked.groupBy("mark").agg(F.count("*").alias("load")).where(f"load > {chunk}")
    dealt = marked.join(heavy, "mark", "left").withColumn(
        "chunk", F.expr(f"pmod(xxhash64(turn), ceil(coalesce(load, 1) / {chunk}D))"))
    met = dealt.selectExpr("rep", "size", "first(struct(rep, size)) OVER (PARTITION BY mark, chunk ORDER BY turn, rep "
                           "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor")
    return met.where(
        f"rep <> anchor.rep AND 100 * least(size, anchor.size) >= {percent} * greatest(size, anchor.size)",
    ).selectExpr("rep AS a", "anchor.rep AS b")


def all_pairs(members: DataFrame, reps: DataFrame, percent: int, chunk: int = CHUNK, nearest: int | None = None) -> DataFrame:
    """Candidates ``(a, b)``: all pairs that share a prefix token, pass the filters and are not connected.

    The sketches are a filter for tokens of CROWD representatives or more. With ``nearest``, only these tokens
    count, and each row of one proposes that many partners at most, those that the sketches tell to be the nearest.
    """

    @F.pandas_udf("binary")
    def shorter(sketches: pd.Series) -> pd.Series:
        return sketches.map(folded)

    alive = members.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    rows = members.join(alive.select("token"), "token")
    crowded = rows.where(f"load >= {CROWD}").join(reps.select("rep", shorter("bits").alias("brief")), "rep")
    if nearest is None:
        crowded = rows.where(f"load < {CROWD}").withColumn("brief", F.expr("CAST(NULL AS BINARY)")).unionByName(crowded)
    rows = crowded.selectExpr(
        "token", "rep", "size", "pos", "root", "brief", f"CAST(ceil(load / {chunk}D) AS INT) AS chunks",
    ).selectExpr("*", "CAST(pmod(xxhash64(rep), chunks) AS INT) AS chunk")
    # A token with several chunks: a task for each two of them, and for each one alone.
    rows = rows.selectExpr("*", "explode(sequence(0, chunks - 1)) AS other").selectExpr(
        "token", "least(chunk, other) AS low", "greatest(chunk, other) AS high", "chunk", "rep", "size", "pos", "root", "brief")
    tile = ["token", "low", "high"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in by_key(batches, tile):
            where = piece[tile].to_numpy()
            group = np.cumsum(np.concatenate([[True], (where[1:] != where[:-1]).any(axis=1)]))
            cross = where[:, 1] != where[:, 2]
            chunk_of, rep, brief = piece["chunk"].to_numpy(), piece["rep"].to_numpy(), piece["brief"].tolist()
            size, pos, root = (piece[name].to_numpy(np.int64) for name in ("size", "pos", "root"))
            # Rows of a group lie in order of size: a row's partners are the rows after it, up to its length limit.
            reach = np.searchsorted(group * (1 << 40) + size, group * (1 << 40) + 100 * size // percent, side="right")
            partners = reach - np.arange(len(piece)) - 1
            ends, start = np.cumsum(partners), 0
            while start < len(piece):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, side="right")))
                some = partners[start:stop]
                one = np.repeat(np.arange(start, stop), some)
                two = one + 1 + np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                left = np.minimum(size[one] - pos[one], size[two] - pos[two])
                good = (root[one] != root[two]) & (left >= needed(size[one], size[two], percent))
                good &= ~cross[one] | (chunk_of[one] != chunk_of[two])
                one, two = one[good], two[good]
                differ = least_differences(brief, one, two)
                over = differ - (size[one] + size[two] - 2 * needed(size[one], size[two], percent))
                good = (differ < 0) | (over <= 0)
                if nearest is not None:
                    good &= (differ < 0) | (rank(one, over) < nearest) | (rank(two, over) < nearest)
                a, b = rep[one[good]], rep[two[good]]
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
                start = stop

    return rows.repartition(*tile).sortWithinPartitions(*tile, "size").mapInPandas(compare, "a long, b long").distinct()


def linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold: suffix filter, then the whole sets."""

    @F.pandas_udf("boolean")
    def differ_little(one: pd.Series, other: pd.Series, size: pd.Series, other_size: pd.Series) -> pd.Series:
        room = size + other_size - 2 * needed(size, other_size, percent)
        return pd.Series([least_difference(a, b) <= most for a, b, most in zip(one, other, room)], dtype=bool)

    # Not for use in inferred filters: those would be worked out before the join that leaves most texts out.
    @F.pandas_udf("node binary, tokens binary")
    def sets(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(text, width).tobytes() for text in texts]
        return pd.DataFrame({"node": [hashlib.md5(one).digest() for one in found], "tokens": found})

    @F.pandas_udf("boolean")
    def similar(one: pd.Series, other: pd.Series) -> pd.Series:
        found = []
        for a, b in zip(one, other):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            found.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(found, dtype=bool)

    def side(name: str, table: DataFrame, *columns: str) -> DataFrame:
        return table.select(F.col("rep").alias(name), *(F.col(column).alias(f"{name}_{column}") for column in columns))

    columns = ["size", "bits", "node", "source"]
    described = pairs.join(side("a", reps, *columns), "a").join(side("b", reps, *columns), "b")
    close = stage(described.where(differ_little("a_bits", "b_bits", "a_size", "b_size")).drop(
        "a_size", "a_bits", "b_size", "b_bits"), "close-pairs")
    if close.isEmpty():
        return close.select("a", "b")
    # Staged, so that its size is known when the join with the texts is planned.
    wanted = stage(close.selectExpr("inline(array(struct(a AS rep, a_node AS node, a_source AS source), "
                                    "struct(b AS rep, b_node AS node, b_source AS source)))").distinct(), "wanted")
    texts = docs.join(wanted.select("source"), F.expr("_id <=> source"), "left_semi")
    found = texts.withColumn("_set", sets.asNondeterministic()("_text")).select("_set.*").join(wanted.select("rep", "node"), "node")
    tokens = stage(found.dropDuplicates(["rep"]).select("rep", "tokens"), "token-sets")
    both = close.select("a", "b").join(side("a", tokens, "tokens"), "a").join(side("b", tokens, "tokens"), "b")
    return both.where(similar("a_tokens", "b_tokens")).select("a", "b")


def similar_sets(docs: DataFrame, reps: DataFrame, width: int, percent: int, chunk: int = CHUNK) -> DataFrame:
    """``(node, root)`` for the representatives that are linked with others: the components of all pairs over the threshold."""
    shared = stage(shared_prefixes(reps), "shared-prefixes")
    links, total = docs.sparkSession.createDataFrame([], "a long, b long"), 0
    alone = reps.select("rep", "size", "marks")
    for number in range(MARKS):
        new = stage(linked(anchor_pairs(alone, percent, number, chunk), reps, docs, width, percent), "links")
        links, found = links.union(new), new.count()
        total += found
        if found * 50 <= total:  # the rest is left to the comparison of all
            break
        alone = stage(alone.join(new.select(F.col("a").alias("rep")), "rep", "left_anti"), "alone")
    roots = stage(connected_components(links), "roots")

    def compared(members: DataFrame, nearest: int | None = None) -> tuple[DataFrame, int]:
        """The roots after a comparison, and how many links it found; without any, the roots are those before."""
        rooted = members.join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.expr("coalesce(root, rep)"))
        new = stage(linked(all_pairs(rooted, reps, percent, chunk, nearest), reps, docs, width, percent), "links")
        found = new.count()
        known = roots.selectExpr("node AS a", "root AS b")
        return stage(connected_components(known.union(new)), "roots") if found else roots, found

    crowded = shared.where(f"load >= {CROWD}")
    for _ in range(ROUNDS):
        roots, found = compared(crowded, NEAREST)
        total += found
        if found * 50 <= total:
            break
    # First among those that no anchor has taken, then, with what that joins, among all.
    for members in (shared.join(alone.select("rep"), "rep", "left_semi"), shared):
        roots, _ = compared(members)
    return roots


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 80,
                       chunk: int = CHUNK) -> DataFrame:
    """``(key, n_shingles, component_id)`` for each row of ``docs``.

    Words are longest stretches without ASCII white space, A-Z lower-cased. Two documents are linked if the
    Jaccard similarity of their sets of distinct shingles of ``width`` words is at least ``percent``
    hundredths; fewer words are one shingle. ``component_id`` is the smallest key in reach. A text without
    words, NULL among them, has no shingles, is linked with nothing and gets its own key. Repeated rows
    give a row each. NULL keys are no candidates for ``component_id``, which is NULL where a component has
    no other. Texts of any length are read whole. An empty table gives an empty result. Other columns are
    not read.

    Tokens are 64-bit hashes of shingles, and equal sets are told by 128 bits.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(quoted(key)).alias("_id"), F.col(quoted(text)).alias("_text"))
    sets = stage(token_sets(rows, width, percent), "sets")
    reps = sets.where("size > 0").groupBy("node").agg(
        F.min("_id").alias("source"), F.first("size").alias("size"), F.first("prefix").alias("prefix"),
        F.first("bits").alias("bits"),
        F.first("marks").alias("marks"))
    reps = stage(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    roots = similar_sets(rows, reps, width, percent, chunk)
    known = stage(reps.select(F.col("node").alias("_node"), "rep", "source").join(
        roots, F.col("rep") == F.col("node"), "left").selectExpr("_node", "source", "coalesce(root, rep) AS root"), "classes")
    lowest = known.groupBy("root").agg(F.min("source").alias("component_id"))
    classes = known.join(lowest, "root").select("_node", "component_id")
    return sets.select("_id", "size", "node").join(classes, F.expr("node = _node AND size > 0"), "left").selectExpr(
        f"_id AS {quoted(key)}", "CAST(size AS BIGINT) AS n_shingles", "IF(size = 0, _id, component_id) AS component_id")
