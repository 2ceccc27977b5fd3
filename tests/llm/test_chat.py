from __future__ import annotations

import collections
import itertools
import zlib

import numpy as np
import pytest

from cardloom.llm import chat


@pytest.fixture(scope="module")
def turns(spark):
    return spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")


@pytest.fixture(scope="module")
def model(turns):
    return chat.fit(turns.where("crc32(CAST(conv_id AS STRING)) % 4 <> 2"))


def test_roles_of_held_out_conversations(turns, model):
    got = {r.conv_id: r.roles for r in chat.format_chats(chat.transcripts(turns), model).collect()}
    truth: dict = {}
    for row in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        truth.setdefault(row.conv_id, []).append(row.role)
    held = [c for c in truth if zlib.crc32(str(c).encode()) % 4 == 2]
    right = sum(got[c] == ",".join(truth[c]) for c in held)
    assert len(held) > 10 and right >= 0.85 * len(held)


def test_viterbi_finds_the_best_of_all_paths(model):
    rng = np.random.default_rng(2)
    for size in (1, 2, 4):
        observed = np.stack([rng.integers(0, values, size) for values in chat.FEATURES.values()], axis=1)

        def score(path):
            total = model.start[path[0]] + sum(model.follow[a, b] for a, b in zip(path, path[1:]))
            return total + sum(table[s, observed[i, n]] for i, s in enumerate(path) for n, table in enumerate(model.emit))

        best = max(map(score, itertools.product(range(len(chat.STATES)), repeat=size)))
        assert score(model.decode(observed).tolist()) == pytest.approx(best)
    assert len(model.decode(np.zeros((0, len(chat.FEATURES)), np.int64))) == 0


def test_roles_by_style(turns, model):
    held = [[(turn.role, turn.text or "") for turn in r.turns] for r in
            chat.gathered_turns(turns.where("crc32(CAST(conv_id AS STRING)) % 4 = 2")).collect()]
    for style, least in enumerate([0.99, 0.99, 0.99, 0.93, 0.99, 0.80]):  # names; every fourth turn without a marker
        right = sum([role for role, _ in chat.read_turns(chat.write_transcript(given, style)[0], model)] == [role for role, _ in given]
                    for given in held)
        assert right >= least * len(held), (style, right, len(held))


@pytest.mark.parametrize("style", [0, 1, 2, 4])
@pytest.mark.parametrize("first", ["assistant", "user", "system"])
def test_explicit_markers_are_never_overruled(model, style, first):
    roles = {"assistant": ["assistant", "user"], "user": ["user", "user", "assistant"], "system": ["system", "assistant", "user"]}[first]
    given = [(roles[at % len(roles)], f"text {at}") for at in range(600)]
    assert chat.read_turns(chat.write_transcript(given, style)[0], model) == given


@pytest.mark.parametrize("text", [
    "**User:** hello\n**Assistant:** hi\nthere", "User (10:02): hello\nAssistant (10:03 pm): hi\nthere",
    "[10:02] User: hello\n[10:03:59] Assistant: hi\nthere", "User - hello\nAssistant - hi\nthere",
    "<|im_start|>user\nhello<|im_end|>\n<|im_start|>assistant\nhi\nthere<|im_end|>",
    "Speaker 1: hello\nSpeaker 2: hi\nthere", "<|user|>\nhello\n<|assistant|>\nhi\nthere",
])
def test_foreign_marker_forms(model, text):
    assert chat.read_turns(text, model) == [("user", "hello"), ("assistant", "hi\nthere")]


def test_text_around_markers_is_kept(model):
    text = "User: User\n\n    indented\nAssistant:\n    x = 1\n* item\nUser: * item\nAssistant: **bold** end"
    assert chat.read_turns(text, model) == [
        ("user", "User\n\n    indented"), ("assistant", "    x = 1\n* item"), ("user", "* item"), ("assistant", "**bold** end")]
    assert chat.read_turns("<|im_end|> is a mark", model)[0][1] == "<|im_end|> is a mark"


@pytest.mark.parametrize("style", range(5))
def test_marked_transcripts_round_trip(model, style):
    given = [("system", "Be brief."), ("user", "What is it?\nTell me."), ("assistant", "It is this.\nAnd that."), ("user", "Thanks")]
    if style == 3:
        given = given[1:]
    text, states = chat.write_transcript(given, style)
    assert len(states) == text.count("\n") + 1
    assert chat.read_turns(text, model) == given


@pytest.mark.parametrize("style", range(6))
def test_later_lines_that_look_like_markers_keep_their_text(model, style):
    given = [
        ("user", "Sum it up?\nNote: keep the receipt\nAnswer: in one line"), ("assistant", "Yes.\nTotal: 5 EUR\nAnswer: five\nmodel: gpt"),
        ("user", "And then?\n[Hint] ask\n# Plan > go"), ("assistant", "Done.\nNote: keep it\nNote: and this"),
        ("user", "Thanks a lot.\nResponse: none\nPlease go on?"), ("assistant", "Good.")]
    if style == 5:
        given = given[:3]  # the fourth turn has no marker there
    assert chat.read_turns(chat.write_transcript(given, style)[0], model) == given


def test_text_of_a_single_exchange_is_not_lost(model):
    for style in range(5):
        given = [("user", "Sum it up?"), ("assistant", "Yes.\nNote: keep the receipt\nAnswer: five")]
        got = chat.read_turns(chat.write_transcript(given, style)[0], model)
        assert "\n".join(text for _, text in got) == "\n".join(text for _, text in given)


def test_rendering_marks_are_unambiguous():
    text = chat.render([("user", "say <|end|> now"), ("assistant", "no")])
    assert text.count("<|end|>") == 2 and text.startswith("<|user|>\nsay <end> now\n<|end|>\n<|assistant|>")


def test_messy_turns(spark, model):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, None), (1, None, "user", "lost"), (None, 0, "assistant", ""),
            (None, 0, "user", "stray"), (None, 0, "user", "stray"), (2, 5, "robot", "x\n\n\ny"), (3, 0, "user", "w " * 50_000),
            (1, 1, "assistant", "yo"), (5, -3, "user", "early"), *((4, i, ("user", "assistant")[i % 2], f"line {i}") for i in range(2500)),
            *((6, 7, "user", f"same turn {i:05}") for i in range(3000))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "2 AS style", "3 AS slice")
    written = chat.transcripts(turns)
    got = chat.format_chats(written.selectExpr("*", "1 AS roles", "2 AS _row"), model)
    assert got.columns == ["conv_id", "part", "slice", "transcript", "_row", "n_turns", "roles", "turns", "rendered"]
    found = got.collect()
    # Rows without a number or a conversation stand alone; 2500 turns make three parts, 3000 rows of one turn two.
    assert collections.Counter(r.conv_id for r in found) == {1: 1 + 2, None: 2, 2: 1, 3: 1, 5: 1, 4: 3, 6: 2}
    assert len({(r.conv_id, r.part, r.slice) for r in written.collect()}) == len(found)
    same = [line for r in found if r.conv_id == 6 for line in r.rendered.split("\n") if line.startswith("same turn")]
    assert sorted(same) == [f"same turn {i:05}" for i in range(3000)]
    lines = [line for r in found if r.conv_id == 4 for line in r.rendered.split("\n") if line.startswith("line ")]
    assert sorted(lines) == sorted(f"line {i}" for i in range(2500))
    assert next(r.roles for r in found if r.conv_id == 1 and r.part == 0) == "user,assistant"
    none = spark.createDataFrame([(None,), ("",)], "transcript string")
    assert {r.n_turns for r in chat.format_chats(none, model).collect()} == {1}
    nothing = turns.where("false")
    assert chat.format_chats(chat.transcripts(nothing), chat.fit(nothing)).count() == 0
