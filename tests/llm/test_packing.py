from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cardloom.llm.packing import FirstFit, pack, pack_group
from cardloom.llm.tokens import TokenIds, encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "İstanbul ǅ ﬁ x\u2003y\u0085z\x1cq <|endoftext|>a<|startoftext|> it's I'LL 'S don't's e\u0301 A\u0300BC K Å ſt",
    "\ufeffabc\u200b def", "日本語 テスト １２３ 12.5 ½ ª º µ", "a-b_c!? (x) [y]{z} ~`^ \\ / | <> &&& $$$ %%% 'quoted' \"said\"", "straße STRASSE ÀÉÎ",
    "\u0301 starts with a mark", "\u00a0no\u00a0break\u00a0", "MiXeD123abc 1a2b", "",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_tokenizer(tokenizer, documents):
    ids = encoder(PATH)
    assert ids.latin_words
    for text in TRICKY + [row.text for row in documents.collect()]:
        assert np.frombuffer(ids.encode(text), ids.dtype).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_small_memory_changes_nothing(monkeypatch):
    from cardloom.llm import tokens

    text = " ".join(f"Wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}," for i in range(300))
    whole = TokenIds(PATH).encode(text)
    monkeypatch.setattr(tokens, "KNOWN", 5)
    assert TokenIds(PATH).encode(text) == whole


def first_fit(sizes, length):
    rooms, found = [], []
    for size in sizes:
        at = next((i for i, room in enumerate(rooms) if room >= size), len(rooms))
        if at == len(rooms):
            rooms.append(length)
        rooms[at] -= size
        found.append(at)
    return found


def test_tournament_tree_is_first_fit():
    rng = random.Random(1)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 100) for _ in range(rng.randint(1, 60))), reverse=True)
        tree = FirstFit(len(sizes), 100)
        assert [tree.place(size) for size in sizes] == first_fit(sizes, 100)


@pytest.mark.parametrize("seed", range(20))
def test_groups_are_packed_without_padding(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 7, 4096, 4097, 12_000, rng.randint(1, 6000)]) for _ in range(rng.randint(0, 50))]
    covered = defaultdict(list)
    for sequence in pack_group(sizes):
        total = sum(part[2] for part in sequence)
        assert total == 4096 or total < 4096 and total & (total - 1) == 0
        for doc, start, size in sequence:
            covered[doc].append((start, size))
    for doc, parts in covered.items():
        at = 0
        for start, size in sorted(parts):
            assert start == at and size > 0
            at += size
        assert at == sizes[doc]
    assert len(covered) == len(sizes)


@pytest.mark.parametrize("group_bytes", [4 << 20, 2000])
def test_pieces_round_trip(messy, documents, tokenizer, group_bytes):
    for docs in (documents.union(messy.where("doc_id < 0 OR doc_id IS NULL OR doc_id > 1000000")), messy):
        pieces = pack(docs, PATH, group_bytes=group_bytes).collect()
        by_sequence, total = defaultdict(list), 0
        texts = defaultdict(list)
        for row in docs.collect():
            ids = np.array(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2], "<u4")
            texts[row.doc_id].append(ids)
            total += len(ids)
        assert sum(p.length for p in pieces) == total
        for piece in pieces:
            by_sequence[piece.sequence_id].append(piece)
            assert any(len(ids) == piece.doc_tokens and zlib.crc32(ids[piece.start:piece.start + piece.length].tobytes())
                       == piece.ids_crc32 for ids in texts[piece.doc_id])
        for parts in by_sequence.values():
            at = 0
            for piece in sorted(parts, key=lambda p: p.offset):
                assert piece.offset == at
                at += piece.length
            assert at == 4096 or at < 4096 and at & (at - 1) == 0
        assert {p.doc_id for p in pieces} == set(texts)


def test_partitions_do_not_matter(documents):
    one = sorted(map(tuple, pack(documents.coalesce(1), PATH).collect()))
    assert one == sorted(map(tuple, pack(documents.repartition(7), PATH).collect()))


def test_empty_table_and_extra_columns(empty, messy):
    assert pack(empty, PATH).count() == 0
    assert pack(messy.selectExpr("*", "1 AS start", "2 AS _group"), PATH).columns[:2] == ["doc_id", "start"]
