"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

The features are densities of a lexicon, its nearness to second-person words, and rates of
capitals, punctuation and obfuscation. The model is fitted on a bounded sample of labelled
rows; features and scores cover every whole text, in batches, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import quoted, stage, text_batches, unpacked

# Fixed: insults and abuse, one word each. No word that is an everyday word of another language.
LEXICON = frozenset("""
    idiot idiots idiotic moron morons moronic imbecile imbeciles stupid dumb dumbass fool fools clown clowns loser losers
    scum scumbag trash garbage filth filthy vermin worthless pathetic disgusting repulsive despicable disgrace
    jerk jerks bastard bastards bitch bitches asshole assholes ass shit shitty bullshit crap fuck fucking fucker fucked
    damn dickhead prick cunt slut whore swine coward cowards freak creep degenerate subhuman retard retarded
    dummkopf trottel arschloch scheisse scheiße idioten dreck abschaum
    connard connasse salaud merde crétin débile ordure
    imbécil estúpido estúpida idiota basura mierda pendejo cabrón
""".encode().split())
SECOND_PERSON = frozenset("""
    you your yours yourself yourselves u ur ya thou du dich dir dein deine euch tu te toi ton ta vous votre usted tú ti
    vosotros ustedes
""".encode().split())
# What stands for a letter in a disguised word.
LEET = bytes.maketrans(b"0134578@$!|+", b"oieastbasilt")
SEPARATORS = b".-_*~'^"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LETTER_MARKS = b"@$!|+*"  # punctuation that may be the first or last letter of a disguised word
NEAR = 5  # words between an insult and a second-person word

_UPPER = bytes(range(65, 91))
_LOOSE = PUNCTUATION.translate(None, LETTER_MARKS)
_SHAPES: dict[tuple[int, str], list[str]] = {}  # lexicon by length and first letter
for _word in sorted(word.decode() for word in LEXICON):
    _SHAPES.setdefault((len(_word), _word[0]), []).append(_word)
_TO_SPACE = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))
FEATURES = (
    "hits_log", "hit_density", "distinct_hits", "disguised_log", "disguised_density", "second_person_density",
    "near_second_person", "capital_rate", "shouted_rate", "exclamation_rate", "punctuation_rate", "digit_rate",
    "mixed_word_rate", "words_log", "learned_density", "learned_weight",
)

SAMPLE_ROWS = 20_000  # labelled rows to learn from at most, however many there are
LEARNED_WORDS = 200
LEAF_SHARE = 0.02  # of the fitted rows in a leaf at least: labels have errors that a small leaf would learn
PRIOR_WEIGHT = 3
THRESHOLD = 0.3


def is_disguised(piece: bytes, bare: bytes) -> bool:
    """Whether a lower-case ASCII piece is a word of the lexicon with marks or digits for letters.

    ``bare`` is the piece without punctuation at its ends. A mark at an end may be a letter or not (``$hit``,
    ``idiot!``), so both readings are tried. A star inside stands for any one letter (``f*ck``), after a first
    letter that is given; a single star at the end is a footnote. Numbers are no disguise: ``455`` is not read as letters.
    """
    ends = piece.strip(_LOOSE)
    if bare in LEXICON or (ends == bare and bare.isalpha()):
        return False
    for form in (bare, ends, ends.rstrip(b"!|+*")):
        plain = form.translate(LEET, SEPARATORS)
        if plain in LEXICON and (form.upper() != form or not any(48 <= c < 58 for c in form)):
            return True
    if ends.count(b"*") == 1 and ends.endswith(b"*"):
        return False  # a footnote
    if b"*" not in ends[1:]:
        return False
    masked = ends.translate(LEET, SEPARATORS.replace(b"*", b"")).decode()
    return any(all(c in ("*", d) for c, d in zip(masked, word)) for word in _SHAPES.get((len(masked), masked[0]), ()))


def text_features(text: str | None, learned: dict[bytes, float]) -> list[float]:
    """The features of one text, in the order of FEATURES; all zero for NULL and empty texts."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    low = text.lower().encode()
    words = low.translate(_TO_SPACE).split()
    count, size = max(1, len(words)), len(raw)
    present = set(words)
    insults, persons = present & LEXICON, present & SECOND_PERSON
    at = [i for i, word in enumerate(words) if word in insults] if insults else []
    you = [i for i, word in enumerate(words) if word in persons] if persons else []
    near = sum(any(abs(i - j) <= NEAR for j in you) for i in at) if you else 0
    pieces = low.split()
    disguised = mixed = 0
    for piece in set(pieces):
        if piece.isalpha() or not piece.isascii():
            continue
        bare = piece.strip(PUNCTUATION)
        mixed += not bare.isalpha() and not bare.isdigit() and bare != b""
        if is_disguised(piece, bare):
            disguised += pieces.count(piece)
    weights = [learned[word] for word in present if word in learned]
    letters = size - len(raw.translate(None, _UPPER))
    shouted = sum(piece.isupper() and len(piece) > 2 for piece in raw.split())
    marks = size - len(raw.translate(None, PUNCTUATION))
    return [
        math.log1p(len(at)), len(at) / count, float(len(insults)), math.log1p(disguised), disguised / count,
        len(you) / count, near / max(1, len(at)), letters / size, shouted / count,
        (raw.count(b"!") + raw.count(b"?")) / count, marks / size,
        (size - len(raw.translate(None, b"0123456789"))) / size, mixed / count, math.log1p(len(words)),
        len(weights) / count, sum(weights),
    ]


def with_features(docs: DataFrame, text: str, learned: dict[bytes, float]) -> DataFrame:
    """``docs`` and ``_features``, an array."""

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_features(text, learned) for text in texts])

    text_batches(docs.sparkSession)
    return docs.withColumn("_features", features(F.col(quoted(text))))


@dataclass(frozen=True)
class ToxicityModel:
    """What scoring needs; without trees every text gets the ``prior``."""

    learned: dict[bytes, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float


def labelled_sample(
    docs: DataFrame, labels: DataFrame, learn_where: str, rows: int, text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """``(_text, label, part)``: at most ``rows`` labelled texts, chosen by a hash of the key.

    Rows with a NULL label or key teach nothing. Of labels that disagree on a key the higher counts, and of
    texts with one key the smallest, so the bound on the keys is one on the texts.
    """
    usable = labels.select(F.col(quoted(key)).alias("_key"), F.col("toxic")).where("_key IS NOT NULL AND toxic IS NOT NULL")
    usable = usable.where(F.expr(learn_where.format("_key"))).groupBy("_key").agg(F.max("toxic").alias("label"))
    share = min(1.0, 0.9 * rows / max(1, usable.count()))
    # A hash below the share picks about nine tenths of ``rows`` keys; that is the bound of the broadcast.
    chosen = usable.where(f"pmod(xxhash64(_key, 'sample'), 1000000) < {round(share * 1_000_000)}").limit(rows)
    texts = docs.select(F.col(quoted(key)).alias("_id"), F.col(quoted(text)).alias("_text"))
    taught = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_key")).groupBy("_key").agg(
        F.min("_text").alias("_text"), F.max("label").alias("label"))
    return taught.selectExpr(
        "_text", "CAST(label > 0 AS DOUBLE) AS label", "CAST(pmod(xxhash64(_key, 'part'), 10) AS INT) AS part")


def learn_words(sample: DataFrame, most: int = LEARNED_WORDS) -> dict[bytes, float]:
    """Words with their log-odds of a toxic text, from the sample's own texts; ``most`` at most.

    A word counts once a text. It must be in ten toxic texts and fifty times as likely there.
    """
    totals = sample.selectExpr("coalesce(sum(label), 0D)", "coalesce(sum(1D - label), 0D)").first()
    words = sample.selectExpr(
        "label", r"explode(array_distinct(split(lower(_text), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))) AS word")
    counts = words.groupBy("word").agg(F.sum("label").alias("bad"), F.sum(F.expr("1D - label")).alias("good"))
    odds = counts.where("word <> '' AND bad >= 10").selectExpr(
        "word", f"ln((bad + 0.5D) / {totals[0] + 1}D) - ln((good + 0.5D) / {totals[1] + 1}D) AS weight")
    top = odds.where(f"weight > {math.log(50)}D").orderBy(F.desc("weight"), "word").limit(most)
    return {row.word.encode(): row.weight for row in top.collect()}


def fit(
    docs: DataFrame, labels: DataFrame, learn_where: str = "crc32(CAST({} AS STRING)) % 4 <> 2",
    rows: int = SAMPLE_ROWS, text: str = "text", key: str = "doc_id", seed: int = 7,
) -> ToxicityModel:
    """Learn from ``rows`` labelled texts at most: word weights, trees and calibration on separate parts."""
    sample = stage(labelled_sample(docs, labels, learn_where, rows, text, key), "toxicity-sample")
    learned = learn_words(sample.where("part < 2"))
    ready = stage(with_features(sample, "_text", learned).select("label", "part", "_features"), "toxicity-features")
    stats = ready.selectExpr(
        "coalesce(avg(label), 0D)", "count_if(part >= 2 AND part < 8 AND label = 0)",
        "count_if(part >= 2 AND part < 8 AND label = 1)", "count_if(part >= 8)").first()
    if not all(stats[1:]):
        return ToxicityModel(learned, None, None, float(stats[0]))
    # A bounded sample, in one order: then a second fit gives the same trees.
    vectors = ready.coalesce(1).sortWithinPartitions("part", "label", "_features").withColumn(
        "_vector", array_to_vector("_features"))
    trees = GBTClassifier(featuresCol="_vector", labelCol="label", maxDepth=3, maxIter=15, stepSize=0.2, seed=seed,
                          minInstancesPerNode=max(8, round((stats[1] + stats[2]) * LEAF_SHARE))).fit(
        vectors.where("part >= 2 AND part < 8"))
    rest = trees.transform(vectors.where("part >= 8")).select("label", vector_to_array("probability")[1].alias("_p1"))
    # A few pseudo-observations say that the trees are right: they matter while there are few rows.
    prior = docs.sparkSession.range(1, 20).selectExpr("id / 20D AS label", "id / 20D AS _p1", f"{PRIOR_WEIGHT}D AS weight")
    calibration = IsotonicRegression(
        featuresCol="_p1", labelCol="label", predictionCol="_score", weightCol="weight",
    ).fit(rest.selectExpr("label", "_p1", "1D AS weight").union(prior))
    return ToxicityModel(learned, trees, calibration, float(stats[0]))


def score(
    docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``score`` in 0 to 1 and ``predicted``, 1 if the score reaches the threshold.

    NULL and empty texts score like a text without any feature. Repeated rows score alike. An
    empty table gives an empty result. Columns named like a result are replaced; the others pass.
    """
    columns = docs.columns if keep is None else list(keep)
    rows = with_features(docs.select(
        F.struct(*(F.col(quoted(name)) for name in columns)).alias("_row"), F.col(quoted(text)).alias("_text"),
    ), "_text", model.learned)
    if model.trees is None:
        return unpacked(rows, columns, score=f"{model.prior!r}D", predicted=f"CAST({model.prior!r}D >= {threshold} AS INT)")
    rows = rows.select("_row", array_to_vector("_features").alias("_vector"))
    rows = model.trees.transform(rows).select("_row", vector_to_array("probability")[1].alias("_p1"))
    # Calibration maps ranges to one value; a thousandth of the trees' own number keeps their order.
    rows = model.calibration.transform(rows).selectExpr("_row", "0.999D * _score + 0.001D * _p1 AS _final")
    return unpacked(rows, columns, score="_final", predicted=f"CAST(_final >= {threshold} AS INT)")


def clean(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that score below the threshold."""
    names = docs.columns
    whole = docs.select(
        F.struct(*(F.col(quoted(name)) for name in names)).alias("_doc"), F.col(quoted(text)).alias("_whole_text"))
    return score(whole, model, "_whole_text", keep=["_doc"], threshold=threshold).where("predicted = 0").select("_doc.*")
