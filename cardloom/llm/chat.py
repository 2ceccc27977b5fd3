"""Chat formatting: a hidden Markov model recovers the roles of a transcript's lines.

The hidden state of a line is its speaker's role and whether the line opens a turn. Observed are
a speaker marker at the line's start (a known word for a role, or the first, second or a later
name) and the line's size, closing question mark and blank neighbour. The model is counted from
transcripts with known roles, Viterbi finds the likeliest states, and the turns are rendered in
one canonical form.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, text_batches

# Fixed: the roles of a canonical turn, and the words that announce them.
ROLES = ("system", "user", "assistant")
WORDS = {
    "system": "system context developer",
    "user": "user human question q instruction prompt customer",
    "assistant": "assistant ai bot answer a response model agent",
}
NAMES = ("Anna", "Boris", "Clara")

MARKERS = ("none", *ROLES, "first name", "second name", "later name")
SIZES = (0, 40, 120, 400)
STATES = [(role, opens) for role in ROLES for opens in (True, False)]
# Values of each observed feature of a line.
FEATURES = {"marker": len(MARKERS), "size": len(SIZES) + 1, "question": 2, "after blank": 2}
PART_TURNS = 1024  # a longer conversation is written as transcripts of so many turn numbers
PART_ROWS = 2048  # and of so many rows at most

# A speaker's marker: an optional time, marks, a word with an optional number or time, closing marks, a colon
# or a closing mark alone. Or the opening mark of a rendered turn, or a role's word before a dash.
_TIME = r"[\[(]\d{1,2}:\d\d(?::\d\d)?(?:\s?[AaPp][Mm])?[\])]"
_MARKER = re.compile(
    rf"\s*(?:{_TIME}\s*)?(?:[#*\[<|]+\s*)?([^\W\d_]{{1,20}}(?: \d{{1,2}})?)(?:\s*{_TIME})?\s*(?:[*\]>|]+\s*)?"
    r"(?::(?:\*+(?:\s+|$)|[ \t]?)|(?<=[\]>|])\s*$|(?<=[\]>|])\s+)"
    r"|\s*<\|im_start\|>\s*(system|user|assistant)\s*"
    r"|\s*(Human|User|Assistant|AI|Bot|System) [-\u2013\u2014] ")
_CLOSING = re.compile(r"<\|im_end\|>\s*$")
_ROLE_OF = {word: ROLES.index(role) for role, words in WORDS.items() for word in words.split()}
_RANK = {word: rank for words in WORDS.values() for rank, word in enumerate(words.split())}


def _word(match: re.Match) -> str:
    """The speaker's word of a marker."""
    return match[1] or match[2] or match[3]


def _speakers(found: list[re.Match | None]) -> tuple[dict[str, int], set[str]]:
    """The words that mark speakers in a transcript, with their markers, and those of them that are surely no text.

    Any line may begin like a marker ('Note: ...', 'Answer: ...'), so a word is judged by the
    whole transcript: speakers take turns. Roles mark the speakers if a role's word is the first,
    else the kind whose two commonest words take more turns. A role has one word: the one in most
    runs of lines marked for that role, of equals the one named first in WORDS. Of names that take
    turns (twice or more) two count, besides one that only opens the transcript. Where fewer than
    two do so all count, and the third and later ones may still be text.
    """
    words = [_word(match) for match in found if match]
    cases = [word.islower() for word in words if word.lower() in _ROLE_OF]
    named, roles, before, role_before, run = Counter(), Counter(), None, None, set()
    for word in words:
        role = _ROLE_OF.get(word.lower())
        if role is None:
            named[word] += word != before
            before = word
        elif word.islower() == cases[0]:
            run = run if role == role_before else set()
            roles[word.lower()] += word.lower() not in run
            run.add(word.lower())
            role_before = role
    leading: dict[int, str] = {}
    for word in sorted(roles, key=lambda word: (-roles[word], _RANK[word])):
        leading.setdefault(_ROLE_OF[word], word)
    by_role = {word: 1 + role for role, word in leading.items()}
    first_is_name = bool(words) and words[0].lower() not in _ROLE_OF
    if named and by_role and first_is_name and len(named) == len(by_role) == 1:
        return by_role | {words[0]: 4}, {*by_role, words[0]}
    ahead = sum(sorted((roles[word] for word in by_role), reverse=True)[:2]) - sum(n for _, n in named.most_common(2))
    if by_role and (not first_is_name or ahead > 0 or len(named) < 2):
        return by_role, set(by_role)
    names = list(named)  # in order of appearance
    often = sorted((name for name in names if named[name] > 1), key=lambda name: -named[name])[:2]
    if len(often) == 2:
        names = [name for name in names if name in often or name == names[0] and named[name] == 1]
    return {name: 4 + min(2, at) for at, name in enumerate(names)}, set(names if len(often) == 2 else names[:2])


def observe(lines: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The features of each line, a row of FEATURES each, the lines without their markers, and which had a sure speaker's."""
    found = [_MARKER.match(line) for line in lines]
    found = [match if match and (_word(match).lower() in _ROLE_OF or _word(match)[0].isupper()) else None for match in found]
    markers, sure = _speakers(found)
    lower = next((_word(match).islower() for match in found if match and _word(match).lower() in _ROLE_OF), None)
    closed = any(match and match[2] for match in found)
    rows, bare, opening = [], [], []
    for at, (line, match) in enumerate(zip(lines, found)):
        word = _word(match) if match else ""
        if word.lower() in _ROLE_OF:
            word = word.lower() if word.islower() == lower else ""
        marker = markers.get(word, 0)
        size = sum(len(line) - (match.end() if marker else 0) > limit for limit in SIZES)
        opening.append(bool(marker) and word in sure)
        without = line[match.end():] if opening[-1] else line
        bare.append(_CLOSING.sub("", without) if closed else without)
        rows.append((marker, size, int(line.rstrip().endswith("?")), int(at > 0 and not lines[at - 1].strip())))
    return np.array(rows, np.int64).reshape(len(lines), len(FEATURES)), bare, np.array(opening, bool)


_OPENS = np.array([opens for _, opens in STATES])
# Whether a state may follow another: a line that opens no turn has the role of the line before.
_FOLLOWS = np.array([[opens or role == before for role, opens in STATES] for before, _ in STATES])
# The states of a line that opens a turn, by its marker.
_ALLOWED = np.array([[opens and (marker not in ROLES or marker == role) for role, opens in STATES] for marker in MARKERS])


@dataclass(frozen=True)
class ChatModel:
    """Logarithms of probabilities: of a first state, of a state after another, of each feature's values."""

    start: np.ndarray
    follow: np.ndarray
    emit: tuple[np.ndarray, ...]

    def decode(self, observed: np.ndarray, opening: np.ndarray | None = None) -> np.ndarray:
        """The likeliest states, by Viterbi; of equally likely ones the first.

        Lines of ``opening`` open a turn, and of the role that their marker names, if it names one. With
        ``opening`` given, an empty line behind another opens none.
        """
        if not len(observed):
            return np.zeros(0, np.int64)
        scores = sum(table[:, observed[:, number]] for number, table in enumerate(self.emit)).T
        if opening is not None:
            empty = (observed[:, 0] == 0) & (observed[:, 1] == 0) & (np.arange(len(observed)) > 0)
            barred = opening[:, None] & ~_ALLOWED[observed[:, 0]] | empty[:, None] & _OPENS
            scores = np.where(barred, -np.inf, scores)
        back = np.zeros(scores.shape, np.int64)
        best = self.start + scores[0]
        for line in range(1, len(scores)):
            paths = best[:, None] + self.follow
            back[line] = paths.argmax(axis=0)
            best = paths.max(axis=0) + scores[line]
        states = np.zeros(len(scores), np.int64)
        states[-1] = best.argmax()
        for line in range(len(scores) - 1, 0, -1):
            states[line - 1] = back[line, states[line]]
        return states


def _slots() -> tuple[int, list[int]]:
    """Length of a vector of counts, and where the table of each feature starts in it."""
    count = len(STATES)
    at, places = count + count * count, []
    for values in FEATURES.values():
        places.append(at)
        at += count * values
    return at, places


def count_states(observed: np.ndarray, states: np.ndarray) -> np.ndarray:
    """Counts of first states, transitions and emissions of one transcript, in one vector."""
    length, places = _slots()
    counts, size = np.zeros(length, np.int64), len(STATES)
    if len(states):
        counts[states[0]] += 1
        np.add.at(counts, size + states[:-1] * size + states[1:], 1)
        for number, values in enumerate(FEATURES.values()):
            np.add.at(counts, places[number] + states * values + observed[:, number], 1)
    return counts


def model_of(counts: np.ndarray) -> ChatModel:
    """Probabilities from counts, one added to each that can occur; without counts all are alike."""
    def logs(table: np.ndarray, possible: np.ndarray | bool = True) -> np.ndarray:
        smooth = np.where(possible, table + 1.0, 0.0)
        with np.errstate(divide="ignore"):
            return np.log(smooth / smooth.sum(axis=-1, keepdims=True))

    size, (_, places) = len(STATES), _slots()
    return ChatModel(
        logs(counts[:size], _OPENS), logs(counts[size:size + size * size].reshape(size, size), _FOLLOWS),
        tuple(logs(counts[at:at + size * values].reshape(size, values)) for at, values in zip(places, FEATURES.values())))


def write_transcript(turns: list[tuple[str | None, str | None]], style: int) -> tuple[str, list[int]]:
    """Turns ``(role, text)`` as plain text, and the state of each line; unknown roles count as user.

    Styles differ in their markers; in one every fourth turn has none, in one turns are set
    apart by blank lines.
    """
    lines: list[str] = []
    states: list[int] = []
    style %= 6
    for at, (role, text) in enumerate(turns):
        number = ROLES.index(role) if role in ROLES else 1
        word = WORDS[ROLES[number]].split()[style % 3]
        if style == 3:
            marker = f"{NAMES[(number - 1) % 3]}: "
        elif style == 4:
            marker = f"### {word.title()}: "
        elif style == 5:
            marker = "" if at % 4 == 3 else f"{word.title()}: "
        else:
            marker = f"{word.title()}: "
        parts = (text or "").split("\n")
        parts[0] = marker + parts[0]
        if style == 2:
            parts.append("")
        lines.extend(parts)
        states.extend([2 * number] + [2 * number + 1] * (len(parts) - 1))
    return "\n".join(lines), states


def read_turns(transcript: str, model: ChatModel) -> list[tuple[str, str]]:
    """Turns ``(role, text)`` of a transcript. A turn ends where a line opens one or the role changes.

    A line with the marker of a sure speaker opens a turn, and only such a line loses its marker.
    """
    observed, bare, opening = observe(transcript.split("\n"))
    turns: list[tuple[str, list[str]]] = []
    for state, without in zip(model.decode(observed, opening), bare):
        role, opens = STATES[state]
        if opens or not turns or turns[-1][0] != role:
            turns.append((role, []))
        turns[-1][1].append(without)
    return [(role, _trimmed(lines)) for role, lines in turns]


def _trimmed(lines: list[str]) -> str:
    """The lines of a turn without blank lines and white space around them; the first keeps its indentation."""
    first = next((at for at, line in enumerate(lines) if line.strip()), len(lines))
    return "\n".join(lines[first:]).rstrip()


def render(turns: list[tuple[str, str]]) -> str:
    """The canonical form. Text that looks like one of its marks loses the bar, so marks are unambiguous."""
    return "\n".join(
        f"<|{role}|>\n{text.replace('<|', '<').replace('|>', '>')}\n<|end|>" for role, text in turns)


def gathered_turns(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(_id, part, slice, style, turns)``: the turns of a conversation in order, by parts of bounded length.

    A row that repeats turn, role and text counts once, before turns are gathered, so a hot
    conversation is combined where it is read. A part has PART_TURNS turn numbers and PART_ROWS
    rows at most; turns of one number are in order of role and text. A row without a number, or
    without a conversation, belongs to no other row: it is a transcript of its own, with a NULL
    part and a slice by its hash.
    """
    once = conversations.selectExpr(f"{quoted(key)} AS _id", "turn", "role", "text").distinct()
    whole = "_id IS NOT NULL AND turn IS NOT NULL"
    placed = once.selectExpr("*", f"IF({whole}, floor(turn / {PART_TURNS}), NULL) AS part",
                             f"IF({whole}, 0L, xxhash64(turn, role, text)) AS alone")
    # Sorted, so it spills; only rows that share their turn numbers are numbered together, and no list exceeds PART_ROWS.
    in_order = "row_number() OVER (PARTITION BY _id, part, alone ORDER BY turn, role, text)"
    numbered = placed.selectExpr("*", f"IF(part IS NULL, alone, floor(({in_order} - 1) / {PART_ROWS})) AS slice")
    return numbered.groupBy("_id", "part", "alone", "slice").agg(
        F.expr("array_sort(collect_list(struct(turn, role, text))) AS turns")
    ).selectExpr("_id", "part", "slice", "CAST(pmod(xxhash64(_id, alone), 6) AS INT) AS style", "turns")


def transcripts(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, part, slice, transcript)``: conversations as plain text, in a style by the hash of the key."""

    @F.pandas_udf("string")
    def written(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for many, styles in batches:
            yield pd.Series([write_transcript([(turn["role"], turn["text"]) for turn in turns], int(style))[0]
                             for turns, style in zip(many, styles)])

    text_batches(conversations.sparkSession)
    found = gathered_turns(conversations, key)
    return found.select(F.col("_id").alias(key), "part", "slice", written("turns", "style").alias("transcript"))


def fit(conversations: DataFrame, key: str = "conv_id") -> ChatModel:
    """Count the model over all the conversations given; only the vector of counts reaches the driver."""

    @F.pandas_udf("array<long>")
    def counts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for many, styles in batches:
            found = []
            for turns, style in zip(many, styles):
                text, states = write_transcript([(turn["role"], turn["text"]) for turn in turns], int(style))
                found.append(count_states(observe(text.split("\n"))[0], np.array(states, np.int64)))
            yield pd.Series(found)

    text_batches(conversations.sparkSession)
    summed = gathered_turns(conversations, key).select(F.posexplode(counts("turns", "style")).alias("at", "n"))
    total = np.zeros(_slots()[0], np.int64)
    for row in summed.groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[row.at] = row.n
    return model_of(total)


def format_chats(rows: DataFrame, model: ChatModel, transcript: str = "transcript", keep: list[str] | None = None) -> DataFrame:
    """``rows`` with ``n_turns``, ``roles`` (joined by commas), ``turns`` and ``rendered``.

    A NULL transcript counts as empty: one turn without text. Lines before any marker, and
    repeated, empty or very long ones, are lines like others. An empty table gives an empty
    result. Columns named like a result are replaced.
    """
    columns = rows.columns if keep is None else list(keep)
    kind = "turns array<struct<role: string, text: string>>, rendered string"

    @F.pandas_udf(kind)
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [read_turns(text or "", model) for text in texts]
            yield pd.DataFrame({"turns": [[{"role": role, "text": text} for role, text in turns] for turns in found],
                                "rendered": [render(turns) for turns in found]})

    text_batches(rows.sparkSession)
    result = rows.select(F.struct(*(F.col(quoted(name)) for name in columns)).alias("_row"),
                         parsed(F.col(quoted(transcript))).alias("_new"))
    clash = {"n_turns", "roles", "turns", "rendered"}
    return result.select(
        *(F.col("_row")[name].alias(name) for name in columns if name.lower() not in clash),
        F.expr("CAST(size(_new.turns) AS BIGINT) AS n_turns"), F.expr("array_join(_new.turns.role, ',') AS roles"),
        F.col("_new.turns").alias("turns"), F.col("_new.rendered").alias("rendered"))
