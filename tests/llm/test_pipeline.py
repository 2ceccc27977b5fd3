from __future__ import annotations

import public_tokenizers

import __spark_entry__
import corpus_pipeline
from cardloom.llm import toxicity
from cardloom.llm.common import stage
from cardloom.llm.queries import QUERIES
from cardloom.llm.queries_sql import ORACLE_SQL
from tests.llm.test_exact_dedup import LOWER
from tests.llm.test_mixing import words
from tests.llm.test_simhash import brute, classes

SF = "/root/testdata/sf0.001"


def test_all_ten_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))
    found = __spark_entry__.queries()
    assert set(QUERIES) <= set(found) and found["pipeline"] is corpus_pipeline.run
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, SF), name)
        steps[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns and docs.schema.simpleString() == before.schema.simpleString()

    before, after = steps["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rejected = toxicity.score(before, toxicity.fit(before, labels, "crc32(CAST({} AS STRING)) % 4 <> 2")).where("predicted = 1")
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in rejected.collect()} == {r.doc_id for r in after.collect()}

    before, after = steps["exact_dedup"]
    best: dict = {}
    for r in before.collect():
        norm = (r.text or "").translate(LOWER)
        best[norm] = max(best.get(norm, r.doc_id), r.doc_id)
    assert sorted(best.values()) == sorted(r.doc_id for r in after.collect())

    before, after = steps["simhash_dedup"]
    prints = {r.doc_id: brute(r.text) for r in before.collect()}
    number = classes(set(prints.values()))
    lowest: dict = {}
    for doc_id in sorted(prints):
        lowest.setdefault(number[prints[doc_id]], doc_id)
    assert sorted(lowest.values()) == sorted(r.doc_id for r in after.collect())

    before, after = steps["mixing"]
    total = sum(words(r.text) for r in before.collect())
    taken = sum(words(r.text) for r in after.collect())
    assert abs(taken - 1.5 * total) <= 0.2 * total
    assert after.exceptAll(before.union(before)).isEmpty()

    before, after = steps["packing"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect())
    assert sum(r.length for r in after.collect()) == ids


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0
