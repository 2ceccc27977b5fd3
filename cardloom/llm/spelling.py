"""Spelling variants: words one edit apart, found through a trie of letter-group counts.

Every letter belongs to one of GROUPS groups, and a word's vector says how many letters of each
group it has. One edit changes a vector by at most one too many in one group and one too few in
another. So the words near to a word lie, in a trie whose levels are the groups' counts, on paths
that leave its own path by a surplus of one and a deficit of one at most. A depth-first search
follows these paths, and the words at their leaves are verified letter by letter.

Spark deals the trie by its first levels: each of its subtrees is a key. A word is stored under its
own key, and visits the keys that its budget reaches, in one direction only, so that each pair
meets once. The number of levels that make the key follows from the largest subtree. Where even
the deepest key is crowded, its words are dealt again by their halves: of two words one edit apart,
the first halves or the last are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import by_key, quoted, stage

GROUPS = 32
DEEPEST = 8  # levels in a key at most; a count takes a byte of it
CROWDED = 1 << 18  # words and visitors of a key beyond which it is dealt by halves
BLOCK = 1 << 16  # (node, word) states that a step of the search expands together
SPARSE = 16  # a node with so few words is not descended further: its words are compared


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = 7, min_count: int = 2,
               edit: str = "_run") -> DataFrame:
    """``(word, n)``: the runs of Latin letters of all texts, A-Z lower-cased, and how often each occurs.

    A run is a longest stretch of ``[A-Za-z]`` and U+00C0 to U+00FF. ``edit`` is SQL over ``_run``, a
    lower-cased run, and ``_id``, its document's key. Results shorter than ``min_length`` code points
    or rarer than ``min_count`` do not count. NULL and empty texts have no words; repeated rows count
    each time; a text of any length is read whole. Counts are combined before the shuffle.
    """
    runs = docs.select(F.col(quoted(key)).alias("_id"), F.col(quoted(text)).alias("_text")).selectExpr(
        "_id", f"explode(regexp_extract_all(_text, '[A-Za-z\\u00C0-\\u00FF]{{{min_length},}}', 0)) AS _run")
    # lower() would also change the capitals beyond A-Z; runs that have some are rare.
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lowered = runs.selectExpr("_id", f"CASE WHEN _run RLIKE '[\\u00C0-\\u00DE]' THEN translate(_run, '{upper}', '{lower}') "
                                     "ELSE lower(_run) END AS _run")
    words = lowered.selectExpr(f"{edit} AS word").where(f"length(word) >= {min_length}")
    return words.groupBy("word").agg(F.expr("count(*) AS n")).where(f"n >= {min_count}")


def vectors(words: list[str]) -> np.ndarray:
    """A row of GROUPS counts for each word, 255 at most: counts that differ by one still do so, or agree."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    cells = np.repeat(np.arange(len(words)) * GROUPS, sizes) + letters % GROUPS
    counts = np.bincount(cells, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return np.minimum(counts, 255).astype(np.uint8)


def _ends(words: list[str]) -> np.ndarray:
    """A row for each word: its length, its first three letters and its last three as numbers."""
    packed = [(len(word), ord(word[0]) << 42 | ord(word[1]) << 21 | ord(word[2]),
               ord(word[-3]) << 42 | ord(word[-2]) << 21 | ord(word[-1])) if len(word) > 2 else (len(word), 0, 0)
              for word in words]
    return np.array(packed, np.int64).reshape(-1, 3)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def _steps(depth: int) -> list[np.ndarray]:
    """What a budget of one surplus and one deficit changes in ``depth`` counts, forwards only.

    Forwards: nothing, or the first change is a surplus. The other changes are these ones reversed.
    """
    unit = np.eye(depth, dtype=np.int16)
    changes = [np.zeros(depth, np.int16), *unit]
    changes += [unit[i] - unit[j] for i in range(depth) for j in range(i + 1, depth)]
    return changes


def _keys(counts: np.ndarray) -> np.ndarray:
    """Counts of the first levels as one number: a byte each."""
    weights = np.uint64(256) ** np.arange(counts.shape[1], dtype=np.uint64)
    return (counts.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)


def _halves(words: DataFrame, crowded: DataFrame) -> DataFrame:
    """Adds ``half``: empty, or in a crowded key which halves of the word make its group.

    The shorter word of a pair sets the half's length, so a word of even length has halves of two.
    """
    def half(side: str, cut: str, length: str) -> str:
        return f"concat('{side}', {length}, ':', {cut})"

    lengths = ["CAST(length(word) DIV 2 AS INT)", "CAST((length(word) - 1) DIV 2 AS INT)"]
    parts = [half("<", f"left(word, {size})", size) for size in lengths] + [
        half(">", f"right(word, {size})", size) for size in lengths]
    marked = words.join(crowded.selectExpr("key", "true AS _crowded"), "key", "left")
    return marked.selectExpr(
        "key", "home", "word", "n",
        f"explode(CASE WHEN _crowded THEN array_distinct(array({', '.join(parts)})) ELSE array('') END) AS half")


class _Trie:
    """The words stored under some keys, level by level: sorted (node, count) pairs and their spans."""

    def __init__(self, place: np.ndarray, counts: np.ndarray):
        self.order = np.lexsort((*counts.T[::-1], place))
        self.counts = counts[self.order]
        self.roots, nodes = np.unique(place[self.order], return_inverse=True)
        self.spans, self.children = [self._span(nodes)], []
        for level in range(counts.shape[1]):
            pairs, nodes = np.unique(nodes * 256 + self.counts[:, level], return_inverse=True)
            self.children.append(pairs)
            self.spans.append(self._span(nodes))

    @staticmethod
    def _span(nodes: np.ndarray) -> np.ndarray:
        """First row of each node, and the number of rows."""
        return np.searchsorted(nodes, np.arange(nodes[-1] + 2)) if len(nodes) else np.zeros(1, np.int64)

    def search(self, place: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (stored row, searching row) whose vectors one edit can explain."""
        at = np.searchsorted(self.roots, place)
        known = np.flatnonzero((at < len(self.roots)) & (self.roots[np.minimum(at, len(self.roots) - 1)] == place))
        nothing = np.zeros(len(known), np.int8)
        stack = [(0, at[known], known, nothing, nothing)]
        counts = counts.astype(np.int16)
        while stack:
            level, node, row, surplus, deficit = stack.pop()
            if not len(node):
                continue
            if len(node) > BLOCK:
                stack.append((level, node[BLOCK:], row[BLOCK:], surplus[BLOCK:], deficit[BLOCK:]))
                node, row, surplus, deficit = node[:BLOCK], row[:BLOCK], surplus[:BLOCK], deficit[:BLOCK]
            first, last = self.spans[level][node], self.spans[level][node + 1]
            leaf = (last - first <= SPARSE) | (level == len(self.children))
            if leaf.any():
                yield from self._leaves(first[leaf], last[leaf], row[leaf], counts)
                node, row, surplus, deficit = node[~leaf], row[~leaf], surplus[~leaf], deficit[~leaf]
            if not len(node):
                continue
            pairs, wanted = self.children[level], counts[row, level]
            ahead = []
            for change in (-1, 0, 1):
                able = np.flatnonzero((surplus + (change > 0) <= 1) & (deficit + (change < 0) <= 1))
                wants = wanted[able] + change
                target = node[able] * 256 + wants
                child = np.minimum(np.searchsorted(pairs, target), len(pairs) - 1)
                hit = (pairs[child] == target) & (wants >= 0) & (wants <= 255)
                go = able[hit]
                ahead.append((child[hit], row[go], surplus[go] + np.int8(change > 0), deficit[go] + np.int8(change < 0)))
            stack.append((level + 1, *map(np.concatenate, zip(*ahead))))

    def _leaves(self, first, last, row, counts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = last - first
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):  # bounded blocks, also where many words share a vector
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BLOCK, side="right")))
            some = sizes[start:stop]
            stored = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some) + np.repeat(first[start:stop], some)
            searching = np.repeat(row[start:stop], some)
            change = self.counts[stored] - counts[searching]
            fits = ((change * (change > 0)).sum(axis=1) <= 1) & ((change * (change < 0)).sum(axis=1) >= -1)
            yield self.order[stored[fits]], searching[fits]
            start = stop


def _near_in_keys(rows: pd.DataFrame, order: list[int]) -> list[tuple[str, str, int]]:
    """(word, near word, how often the near word occurs), both ways, for all pairs that meet in these sorted keys."""
    home = rows["home"].to_numpy()
    if not home.any():
        return []
    words, numbers = rows["word"].tolist(), rows["n"].tolist()
    where = rows[["key", "half"]]
    place = np.cumsum((where != where.shift()).any(axis=1).to_numpy())
    halves, counts = rows["half"].tolist(), vectors(words)[:, order]
    stored, ends = np.flatnonzero(home), _ends(words)
    found = []
    for inside, searching in _Trie(place[stored], counts[stored]).search(place, counts):
        # One edit leaves the first half or the last as it is; most candidates fail this at three letters.
        one_end, other_end = ends[stored[inside]], ends[searching]
        alike = ((one_end == other_end)[:, 1:].any(axis=1)) | (one_end[:, 0] < 6) | (other_end[:, 0] < 6)
        for a, b in zip(stored[inside[alike]].tolist(), searching[alike].tolist()):
            one, other = words[a], words[b]
            if home[b] and one >= other:  # two words of one key: once, and not with itself
                continue
            if halves[a] and not _this_half(halves[a], one, other):
                continue
            if one_edit(one, other):
                found.append((one, other, numbers[b]))
                found.append((other, one, numbers[a]))
    return found


def _this_half(half: str, one: str, other: str) -> bool:
    """Whether a pair is reported by this group, of those in which it meets."""
    size = min(len(one), len(other)) // 2
    if int(half[1:half.index(":")]) != size:
        return False
    return half[0] == "<" or one[:size] != other[:size]


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(word, near, near_n)`` for each word of ``words(word, n)`` and each one that is one edit apart.

    Words are distinct and not NULL, of two code points at least.
    """
    @F.pandas_udf("binary")
    def vector_of(batch: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in vectors(batch.tolist())])

    # Levels in order of falling variance: the first ones tell most words apart.
    counted = stage(words.select("word", "n", vector_of("word").alias("_vector")), "words")
    cells = [f"CAST(conv(hex(substring(_vector, {i + 1}, 1)), 16, 10) AS INT)" for i in range(GROUPS)]
    spread = counted.selectExpr(*(f"coalesce(var_pop({cell}), 0) AS v{i}" for i, cell in enumerate(cells))).first()
    order = sorted(range(GROUPS), key=lambda i: (-spread[i], i))

    # The largest subtree by number of levels, from counts by the deepest key.
    top = [f"c{i}" for i in range(DEEPEST)]
    leaves = counted.groupBy(*(F.expr(cells[order[i]]).alias(name) for i, name in enumerate(top))).agg(F.count("*").alias("size"))
    sizes = leaves.rollup(*top).agg(F.sum("size").alias("size"), F.expr("grouping_id()").alias("open"))
    largest = {row.open: row.most for row in sizes.groupBy("open").agg(F.max("size").alias("most")).collect()}
    fits = [depth for depth in range(DEEPEST + 1) if largest.get((1 << (DEEPEST - depth)) - 1, 0) <= crowded // 16]
    depth = fits[0] if fits else DEEPEST
    steps, levels = _steps(depth), order[:depth]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = vectors(batch["word"].tolist())[:, levels].astype(np.int16)
            for step in steps:
                moved = own + step
                inside = ((moved >= 0) & (moved <= 255)).all(axis=1)
                yield pd.DataFrame({"key": _keys(moved[inside]), "home": not step.any(), "word": batch["word"][inside],
                                    "n": batch["n"][inside]})

    placed = counted.select("word", "n").mapInPandas(place, "key long, home boolean, word string, n long")
    loads = placed.groupBy("key").agg(F.count("*").alias("size"), F.max("home").alias("used")).where("used")
    heavy = stage(loads.where(F.col("size") > crowded).select("key"), "crowded-keys")
    if heavy.isEmpty():
        dealt = placed.selectExpr("key", "home", "word", "n", "'' AS half")
    else:
        dealt = _halves(placed, heavy)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_key(batches, ["key", "half"]):
            found = _near_in_keys(rows, order)
            if found:
                yield pd.DataFrame(found, columns=["word", "near", "near_n"])

    return dealt.repartition("key", "half").sortWithinPartitions("key", "half").mapInPandas(
        search, "word string, near string, near_n long")


def variants(words: DataFrame, ratio: int = 10, crowded: int = CROWDED) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of ``words(word, n)``.

    ``form`` is the most frequent near word, the smallest in code-point order of those that tie, if it
    occurs at least ``ratio`` (two or more) times as often as the word; else NULL, as is ``form_n``.
    ``root`` follows forms to the last one and is the word itself where it has none. An empty table
    gives an empty result.
    """
    words = stage(words.select("word", "n"), "vocabulary")
    best = near_words(words, crowded).groupBy(F.col("word").alias("_word")).agg(
        F.count("*").alias("n_near"), F.expr("min(struct(-near_n AS less, near)) AS best"))
    known = stage(words.join(best, F.expr("word = _word"), "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", f"-best.less >= {ratio} * n AS common", "best.near AS near",
        "-best.less AS near_n",
    ).selectExpr("word", "n", "n_near", "IF(common, near, NULL) AS form", "IF(common, near_n, NULL) AS form_n"), "forms")
    roots = _roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(roots.withColumnRenamed("word", "_word"), F.expr("word = _word"), "left").selectExpr(
        "word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: every round doubles the steps followed; a step multiplies the count, so they are few."""
    roots = stage(forms.selectExpr("word", "form AS root"), "roots")
    while True:
        ahead = roots.selectExpr("word AS _at", "root AS _next")
        moved = roots.join(ahead, F.expr("root = _at"), "left").selectExpr(
            "word", "coalesce(_next, root) AS root", "_next IS NOT NULL AS _moved")
        roots = stage(moved, "roots")
        if roots.where("_moved").isEmpty():
            return roots.drop("_moved")
