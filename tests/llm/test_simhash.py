from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from cardloom.llm import components, simhash
from cardloom.llm.components import connected_components


def brute(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(values, distance=4):
    """Component number of each distinct value, by comparing all."""
    values, number = list(values), {}
    for value in values:
        near = {number[other] for other in number if bin(value ^ other).count("1") <= distance}
        new = min(near, default=len(number))
        number = {k: new if v in near else v for k, v in number.items()}
        number[value] = new
    return number


def check(docs, **options):
    got = simhash.near_duplicates(docs, **options).collect()
    want = {(row.doc_id, f"{brute(row.text):016x}") for row in docs.collect()}
    assert {(r.doc_id, r.fingerprint) for r in got} == want and len(got) == docs.count()
    number = classes({int(r.fingerprint, 16) for r in got})
    lowest: dict = {}
    for r in got:
        group = number[int(r.fingerprint, 16)]
        if r.doc_id is not None:
            lowest[group] = min(lowest.get(group, r.doc_id), r.doc_id)
    assert all(r.component_id == lowest.get(number[int(r.fingerprint, 16)]) for r in got)
    return number


def test_messy_and_given_documents(messy, documents):
    check(messy)
    check(documents, tile=3)


def test_near_copies_are_found(make_docs):
    rng, base = random.Random(3), [f"w{i}" for i in range(400)]
    texts = []
    for i in range(60):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(400)] = f"new{rng.random()}"
        texts.append(" ".join(words))
    number = check(make_docs(*texts, *(" ".join(f"v{i * 1000 + j}" for j in range(50)) for i in range(20))))
    assert len(set(number.values())) < len(number)


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_every_close_pair_shares_a_key(blocks):
    rng, masks = random.Random(blocks), simhash.block_masks(blocks, 4)
    for _ in range(500):
        one = rng.getrandbits(64)
        other = one
        for bit in rng.sample(range(64), 4):
            other ^= 1 << bit
        assert any(one & mask == other & mask for mask in masks)


def test_more_fingerprints_get_longer_keys():
    assert simhash.choose_blocks(10**5, 4) <= simhash.choose_blocks(10**7, 4) < simhash.choose_blocks(10**10, 4)


@pytest.mark.parametrize("tile, count", [(5, 40), (2, 400), (8192, 400)])
def test_links_join_what_all_pairs_join(spark, tile, count):
    rng = random.Random(count)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for centre in centres for _ in range(count // 6)}
    signed = [int(np.uint64(value).view(np.int64)) for value in values]
    frame = spark.createDataFrame([(value,) for value in signed], "_fp long")
    links = simhash.close_links(frame, 4, 10**7 if tile == 5 else count, tile)
    roots = {row.node: row.root for row in connected_components(links).collect()}
    number = classes(values)
    found = {value: roots.get(s, s) for value, s in zip(values, signed)}
    assert len({(number[value], found[value]) for value in values}) == len(set(number.values())) == len(set(found.values()))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000), (1003, 1000)]
    got = {row.node: row.root for row in connected_components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_stars_are_not_contracted_again(spark, monkeypatch):
    rounds, step = [], components._small_star
    monkeypatch.setattr(components, "_small_star", lambda pairs: rounds.append(1) or step(pairs))

    def roots(*links):
        rounds.clear()
        return {row.node: row.root for row in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}

    assert roots((1, 5), (6, 1), (1, 6), (2, 7), (3, 3), (8, None)) == {1: 1, 5: 1, 6: 1, 2: 2, 7: 2} and not rounds
    assert roots((5, 1), (5, 2)) == {1: 1, 2: 1, 5: 1} and rounds  # a node with two smaller ones
    assert roots((1, 2), (2, 3)) == {1: 1, 2: 1, 3: 1} and rounds  # a node that is smaller and larger


def test_one_of_each(messy, empty, documents):
    docs = documents.selectExpr("*", "1 AS root", "2 AS _fp", "3 AS component_id")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    wanted = {row.component_id for row in simhash.near_duplicates(documents).collect()}
    ids = [row.doc_id for row in kept.collect()]
    assert sorted(ids) == sorted(wanted)
    assert simhash.one_of_each(messy).count() == len(set(classes({brute(row.text) for row in messy.collect()}).values()))
    assert simhash.one_of_each(empty).count() == 0 == simhash.near_duplicates(empty).count()
