from __future__ import annotations

from collections import Counter, defaultdict

import public_tokenizers
import pytest

from cardloom.llm.token_counts import RULES, attribute, count_tokens, encoding, sections_of, token_spans

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FIELDS = ("source", "lang", "text")


def brute(values, rule):
    """Tokens of each section, character by character."""
    text, sections = sections_of(values, len(values) - 1)
    starts = [start for *_, start in sections] + [len(text)]
    owner = [i for i in range(len(sections)) for _ in range(starts[i], starts[i + 1])]
    of_byte = [i for i, c in enumerate(text) for _ in c.encode()]
    coder, at, counts = encoding(RANKS, PATTERN)[0], 0, [0] * len(sections)
    for token in coder.encode_ordinary(text):
        size = len(coder.decode_single_token_bytes(token))
        inside = [owner[c] for c in sorted(set(of_byte[at:at + size]))]
        at += size
        share = Counter(inside)
        counts[{"start": inside[0], "end": inside[-1]}.get(rule, min(share, key=lambda s: (-share[s], s)))] += 1
    return [(field, section, start, end - start, count) for (field, section, start), end, count in zip(sections, starts[1:], counts)]


@pytest.mark.parametrize("rule", RULES)
def test_sections_add_up_and_follow_the_rule(documents, messy, rule):
    extra = messy.where("length(text) < 1000 OR text IS NULL")
    for docs in (documents.where("length(text) < 3000"), extra):
        got = defaultdict(Counter)
        for r in count_tokens(docs, RANKS, PATTERN, FIELDS, rule=rule).collect():
            got[r.doc_id][(FIELDS.index(r.field), r.section, r.start, r.chars, r.tokens)] += 1
        want = defaultdict(Counter)
        for r in docs.collect():
            for section in brute([r[f] or "" for f in FIELDS], rule):
                want[r.doc_id][section] += 1
        assert got == {k: v for k, v in want.items() if v}


def test_very_long_text_counts_whole(messy):
    row = messy.where("doc_id = 6")
    got = count_tokens(row, RANKS, PATTERN, FIELDS).collect()
    coder = encoding(RANKS, PATTERN)[0]
    r = row.first()
    assert sum(x.tokens for x in got) == len(coder.encode_ordinary("\n".join([r.source, r.lang, r.text])))


def test_spans_cover_the_text():
    coder, sizes = encoding(RANKS, PATTERN)
    text = "naïve 漢字 \U0001F600 x\n\n\ny"
    starts, ends = token_spans(text, sizes, coder.encode_ordinary(text))
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] <= ends[:-1]).all()


def test_attribution_across_several_sections():
    import numpy as np

    starts, ends, bounds = np.array([0, 2]), np.array([2, 9]), np.array([0, 1, 3, 8, 12])
    assert attribute(starts, ends, bounds, "majority").tolist() == [0, 2]
    assert attribute(starts, ends, bounds, "start").tolist() == [0, 1]
    assert attribute(starts, ends, bounds, "end").tolist() == [1, 3]


def test_empty_clashing_and_wrong_rule(empty, messy):
    assert count_tokens(empty, RANKS, PATTERN, FIELDS).count() == 0
    docs = messy.selectExpr("*", "1 AS f0", "2 AS field", "3 AS _row")
    assert count_tokens(docs, RANKS, PATTERN, FIELDS).columns == ["doc_id", "field", "section", "start", "chars", "tokens"]
    only = count_tokens(messy.where("doc_id = 4"), RANKS, PATTERN, ("text",), split=None)
    assert only.count() == 0  # no character at all
    with pytest.raises(ValueError):
        count_tokens(empty, RANKS, PATTERN, FIELDS, rule="none")
