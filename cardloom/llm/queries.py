"""The registered queries of the training-data operators, by name.

Each applies one operator, with its production parameters, to a whole table of ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cardloom.llm import chat, periodic_runs, toxicity
from cardloom.llm.exact_dedup import exact_dedup
from cardloom.llm.jaccard_join import jaccard_components
from cardloom.llm.line_dedup import dedup_lines
from cardloom.llm.mixing import mix
from cardloom.llm.packing import pack
from cardloom.llm.simhash import near_duplicates
from cardloom.llm.spelling import variants, vocabulary
from cardloom.llm.token_counts import count_tokens
from cardloom.llm.url_filter import Rule, judge_urls
from cardloom.llm.weighted_sampling import fingerprints

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, distance=4, seed=42)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(WORD_TOKENIZER))


# Rows whose labels are held out, as SQL on the document's id.
HELD_OUT = "crc32(CAST({} AS STRING)) % 4 = 2"


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic"), f"NOT ({HELD_OUT})")
    return toxicity.score(docs, model, keep=["doc_id"]).selectExpr(
        "doc_id", f"{HELD_OUT.format('doc_id')} AS held_out", "score", "predicted")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts of several styles, and their roles recovered."""
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    model = chat.fit(turns.where(f"NOT ({HELD_OUT.format('conv_id')})"))
    return chat.format_chats(chat.transcripts(turns), model, keep=["conv_id", "part", "slice"]).drop("turns")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents", "doc_id", "source", "text"), keep=["doc_id"])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"]).drop("kept_text")


# Fixed: the contract's rules.
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
# Names in a host that stand for gambling, pills and adult pages; for URLs that no rule fits.
BLOCKED_WORDS = ("casino", "free-bets", "cheap-pills", "adult")
BLOCKED_GLOBS = [f"*{word}*{rest}" for word in BLOCKED_WORDS for rest in ("", "/**")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, BLOCKED_GLOBS, keep=["page_id"])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("source", "lang", "text")
    return count_tokens(_table(spark, sf_dir, "documents", "doc_id", *fields), public_tokenizers.path(BYTE_RANKS),
                        public_tokenizers.PATTERN, fields)


# Fixed: the contract deletes a letter of one run in 31, by the hash of document and run.
_RUN_HASH = "crc32(concat(coalesce(CAST(_id AS STRING), ''), ':', _run))"
DAMAGED_RUN = (f"CASE WHEN {_RUN_HASH} % 31 = 0 THEN concat(substring(_run, 1, CAST({_RUN_HASH} % length(_run) AS INT)), "
               f"substring(_run, CAST({_RUN_HASH} % length(_run) AS INT) + 2)) ELSE _run END")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return variants(vocabulary(docs, min_length=7, min_count=2, edit=DAMAGED_RUN), ratio=10)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents", "doc_id", "text"), width=5, percent=80)


# Fixed: the contract repeats the words of one document in ten, by the hash of its id.
_ID_HASH = "crc32(CAST(_id AS STRING))"
REPEATED_WORDS = (
    f"IF(_n > 0 AND {_ID_HASH} % 10 = 0, named_struct('from', ({_ID_HASH} DIV 10) % _n, 'period', "
    f"1 + (_n - ({_ID_HASH} DIV 10) % _n) DIV (3 + ({_ID_HASH} DIV 10) % 8)), NULL)")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return periodic_runs.digest(periodic_runs.with_runs(docs, repeat=REPEATED_WORDS))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_fingerprints": op2_fingerprints,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_chat_format": op5_chat_format,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_spelling": op11_spelling,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_periodic_runs": op13_periodic_runs,
}
