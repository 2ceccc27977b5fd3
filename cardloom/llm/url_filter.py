"""URL filter: glob rules as a bit-parallel wildcard automaton over canonical URLs.

All patterns lie end to end in a few 64-bit words, one bit a state. One step reads one byte of
every URL of a batch: shift, mask by the byte, keep the states that a wildcard holds. So all
rules are matched against all URLs of the batch at once, in as many steps as the longest URL
has bytes.

A pattern is matched against the whole of ``.host/path``. ``?`` is one byte but not ``/``, ``*``
any run without ``/``, ``**`` any run; anything else stands for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, text_batches, unpacked

CELLS = 1 << 22  # bytes of URLs in a step's matrix at most, padding included
_SLASH = ord("/")
_PAD = 256


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


class Automaton:
    """Shift-And masks of several globs."""

    def __init__(self, globs: list[str]):
        states: list[tuple[set[int], set[int]]] = []  # bytes that lead here, bytes that stay here
        starts, ends = [], []
        every, inner = set(range(256)), set(range(256)) - {_SLASH}
        for glob in globs:
            starts.append(len(states))
            states.append((set(), set()))
            pattern, at = glob.encode(), 0
            while at < len(pattern):
                if pattern[at:at + 2] == b"**":
                    states[-1][1].update(every)
                    at += 2
                    continue
                if pattern[at] == ord("*"):
                    states[-1][1].update(inner)
                else:
                    states.append((inner if pattern[at] == ord("?") else {pattern[at]}, set()))
                at += 1
            ends.append(len(states) - 1)
        words = max(1, -(-len(states) // 64))
        self.enter, self.stay = np.zeros((257, words), np.uint64), np.zeros((257, words), np.uint64)
        for number, (leads, holds) in enumerate(states):
            word, bit = number // 64, np.uint64(1 << number % 64)
            self.enter[list(leads), word] |= bit
            self.stay[list(holds), word] |= bit
        self.stay[_PAD] = ~np.uint64(0)  # behind its end a URL changes nothing
        self.start = np.zeros(words, np.uint64)
        for number in starts:
            self.start[number // 64] |= np.uint64(1 << number % 64)
        self.ends = [(number // 64, np.uint64(number % 64)) for number in ends]

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """A row for each URL, a column for each glob."""
        found = np.zeros((len(urls), len(self.ends)), bool)
        if not self.ends:
            return found
        order = sorted(range(len(urls)), key=lambda i: len(urls[i]))
        at = 0
        while at < len(order):
            upto = at + 1
            # URLs of like length share a matrix of bounded size; a very long one has its own.
            while upto < len(order) and (upto + 1 - at) * len(urls[order[upto]]) <= CELLS:
                upto += 1
            some = order[at:upto]
            found[some] = self._run([urls[i] for i in some])
            at = upto
        return found

    def _run(self, urls: list[bytes]) -> np.ndarray:
        longest = len(urls[-1])
        text = np.full((longest, len(urls)), _PAD, np.int16)
        for column, url in enumerate(urls):
            text[:len(url), column] = np.frombuffer(url, np.uint8)
        state = np.tile(self.start, (len(urls), 1))
        for byte in text:
            moved = state << np.uint64(1)
            moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
            state = (moved & self.enter[byte]) | (state & self.stay[byte])
        return np.stack([(state[:, word] >> bit) & np.uint64(1) for word, bit in self.ends], axis=1).astype(bool)


def split_url(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    stop = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    tail = rest[stop:]
    end = min((at for at in map(tail.find, "?#") if at >= 0), default=len(tail))
    return rest[:stop].encode().lower().decode(), tail[:end]


def judge_urls(
    pages: DataFrame, rules: list[Rule], blocked: list[str], url: str = "url", keep: list[str] | None = None,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each URL.

    Of the rules that fit the longest wins, of equally long ones a blocking one. Without a rule
    the verdict is block if one of the ``blocked`` globs matches or there is no host, else allow.
    A NULL or empty URL and one without ``://`` have an empty host and path and no rule. Repeated
    rows are judged alike. An empty table gives an empty result. Columns named like a result are
    replaced.
    """
    columns = pages.columns if keep is None else list(keep)
    ranked = sorted(rules, key=lambda rule: (-len(rule.name), rule.verdict != "block", rule.name))
    automaton = Automaton([rule.glob for rule in ranked] + list(blocked))
    names = np.array([rule.name for rule in ranked] + [None], object)
    verdicts = np.array([rule.verdict for rule in ranked], object)

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            parts = [split_url(one) for one in urls]
            hits = automaton.matches([f".{host}{path}".encode() for host, path in parts])
            fits = hits[:, : len(ranked)]
            ruled = fits.any(axis=1)
            first = np.where(ruled, fits.argmax(axis=1) if ranked else 0, len(ranked))
            bare = np.array([not host for host, _ in parts], bool)
            default = np.where(hits[:, len(ranked):].any(axis=1) | bare, "block", "allow").astype(object)
            yield pd.DataFrame({
                "host": [host for host, _ in parts], "path": [path for _, path in parts], "rule": names[first],
                "verdict": np.where(ruled, np.append(verdicts, None)[first], default)})

    text_batches(pages.sparkSession)
    rows = pages.select(F.struct(*(F.col(quoted(name)) for name in columns)).alias("_row"),
                        judged(F.col(quoted(url))).alias("_new"))
    return unpacked(rows, columns, host="_new.host", path="_new.path", rule="_new.rule", verdict="_new.verdict")
