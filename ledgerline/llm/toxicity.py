"""Toxicity scores from boosted trees over dense text features."""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm.common import documents, whole

# Labelled rows to learn from, about, and words to keep of those learned.
TRAINING_ROWS = 24_000
LEXICON_WORDS = 2_000

HELD_OUT_OF = 5

# Common insults, and pronouns of the second person.
INSULTS = """
idiot idiots moron morons stupid dumb loser losers trash garbage scum clown pathetic
worthless disgusting imbecile fool jerk retard bastard bitch asshole shit fuck fucking
hate ugly filthy vermin freak idiota imbécil estúpido basura asco idiote crétin débile
ordure dummkopf blödmann trottel abschaum versager
""".split()
SECOND_PERSON = frozenset(
    "you your yours yourself ur tu toi ton ta tes vous votre vos du dich dir dein deine"
    " ihr euch tú ti te tus vos usted ustedes".split()
)
# Characters that stand for letters in disguised words.
LOOKALIKES = str.maketrans("013457@$!|*", "oieastasiil")

_WORD = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"\b[^\W\d_]++(?:[0-9@$!|*]++[^\W\d_]++)++")
_SPACED = re.compile(r"\b[^\W\d_](?:[ .\-_*][^\W\d_]){3,}\b")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
_RUN_OF_MARKS = re.compile(r"[!?]{2,}")

# Beginnings of words that may be learned as stems, by their length.
STEM_LENGTHS = (4, 5, 6, 7)
STEM = "^"

FEATURES = (
    "insults",
    "learned",
    "learned weight",
    "largest weight",
    "distinct hits",
    "near second person",
    "hits beside second person",
    "second person",
    "capitals",
    "shouted words",
    "exclamations",
    "questions",
    "runs of marks",
    "disguised words",
    "disguised hits",
    "words",
)


class Lexicon(dict):
    """Weights of words, found on first use: of the word itself or of its stems.

    None means a word that is in no list. What was looked up is kept for the next
    text, up to a bounded number of words.
    """

    def __init__(self, weights: dict[str, float], insults: frozenset[str]):
        super().__init__()
        self.weights = weights
        self.insults = insults

    def __missing__(self, word: str) -> float | None:
        units = [word, *(STEM + word[:k] for k in STEM_LENGTHS if len(word) > k)]
        found = max((self.weights[u] for u in units if u in self.weights), default=None)
        if found is None and word in self.insults:
            found = 0.0
        if len(self) > 200_000:
            self.clear()
        self[word] = found
        return found


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The features named in FEATURES; densities are per word or per character."""
    words = _WORD.findall(text.lower())
    if not words:
        return [0.0] * len(FEATURES)
    insults = lexicon.insults
    known = [(i, x) for i, x in enumerate(map(lexicon.__getitem__, words)) if x is not None]
    hits = [i for i, _ in known]
    learned = [weight for _, weight in known if weight]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    nearness, beside = 0.0, 0
    if hits and second:
        at = np.searchsorted(second, hits)
        places = np.array([-(10**9), *second, 10**9])
        distance = np.minimum(np.abs(places[at] - hits), np.abs(places[at + 1] - hits))
        nearness = float(np.exp(-distance / 5.0).max())
        beside = int((distance <= 5).sum())
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    capitals = np.count_nonzero((data >= 65) & (data <= 90))
    disguised = [_undisguise(w) for w in _DISGUISED.findall(text)]
    spaced = [re.sub(r"[^\w]|_", "", w).lower() for w in _SPACED.findall(text)]
    found = [w for w in disguised + spaced if lexicon[w] is not None]
    n, chars = len(words), max(1, len(text))
    return [
        sum(words[i] in insults for i in hits) / n,
        len(learned) / n,
        sum(learned) / n,
        max(learned, default=0.0),
        float(len({words[i] for i in hits})),
        nearness,
        beside / n,
        len(second) / n,
        capitals / chars,
        len(_SHOUTED.findall(text)) / n,
        text.count("!") / chars,
        text.count("?") / chars,
        len(_RUN_OF_MARKS.findall(text)) / n,
        (len(disguised) + len(spaced)) / n,
        len(found) / n,
        math.log1p(n),
    ]


def _undisguise(word: str) -> str:
    return word.lower().translate(LOOKALIKES)


def _feature_column(text: Column, weights: dict[str, float]) -> Column:
    @F.arrow_udf("array<double>")
    def compute(texts: pa.Array) -> pa.Array:
        lexicon = Lexicon(weights, frozenset(INSULTS))
        rows = [features(text.as_py(), lexicon) for text in texts]
        flat = np.array(rows, np.float64).reshape(len(rows), len(FEATURES))
        offsets = pa.array(np.arange(len(rows) + 1) * len(FEATURES), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))

    return array_to_vector(compute(text))


class ToxicityModel:
    """What `fit` learned; `score` adds the column `toxicity`."""

    def __init__(self, weights, trees, calibration, share: float):
        self.weights = weights
        self.trees = trees
        self.calibration = calibration
        self.share = share

    def score(self, docs: DataFrame) -> DataFrame:
        """All columns of `docs`, with `toxicity` from 0 to 1.

        A column of that name gives way. A null text counts as empty. Rows, also
        repeated ones, are scored one by one.
        """
        kept = [c for c in docs.columns if c.lower() != "toxicity"]
        packed = docs.select(F.struct(*kept).alias("row"), whole(F.col("text")).alias("text"))
        if self.trees is None:
            scored = packed.withColumn("toxicity", F.lit(self.share))
        else:
            scored = self._scored(packed)
        return scored.select("row.*", F.least(F.greatest("toxicity", F.lit(0.0)), F.lit(1.0)).alias("toxicity"))

    def _scored(self, rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("features", _feature_column(F.col("text"), self.weights))
        rows = _with_margin(self.trees, rows)
        if self.calibration is None:
            return rows.withColumn("toxicity", F.col("margin"))
        return self.calibration.transform(rows)


def _with_margin(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("probability")[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training_rows: int = TRAINING_ROWS,
    lexicon_words: int = LEXICON_WORDS,
    seed: int = 5,
) -> ToxicityModel:
    """Learn from the texts of labelled documents.

    `labels` has doc_id and toxic (0 or 1); rows with a null in either are left
    out, and a doc_id labelled twice is toxic if one label says so. About
    `training_rows` documents, chosen by a hash of doc_id, are learned from: a part
    of them for the lexicon (words and stems that more toxic documents hold than chance
    allows, `lexicon_words` at most), another for the trees and a third for the
    calibration, so that none judges what it was made from. Without labels of both
    kinds every score is the share of toxic labels, or 0.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("label"))
    )
    total, toxic = marked.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = toxic / total if total else 0.0
    if share in (0.0, 1.0):
        return ToxicityModel({}, None, None, share)
    steps = 1_000_000
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(steps))
    chosen = marked.where(draw < math.ceil(steps * min(1.0, training_rows / total)))
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(10))
    sample = (
        docs.select("doc_id", whole(F.col("text")).alias("text"))
        # About training_rows rows of two numbers.
        .join(F.broadcast(chosen), "doc_id")
        .select("text", "label", part.alias("part"))
    )
    sample = pin(sample).df
    weights = _learn_words(sample.where("part < 4"), lexicon_words)
    rows = pin_features(sample.where("part >= 4"), weights)
    trees = GBTClassifier(maxIter=30, maxDepth=3, stepSize=0.2, seed=seed, maxBins=32)
    own, rest = rows.where("part < 8"), rows.where("part >= 8")
    if not _both_kinds(own):
        return ToxicityModel(weights, None, None, share)
    trees = trees.fit(own)
    calibration = None
    if _both_kinds(rest):
        curve = IsotonicRegression(
            featuresCol="margin", labelCol="label", weightCol="rows", predictionCol="toxicity"
        )
        # Equal margins, as copies have, are one weighted point.
        points = _with_margin(trees, rest).groupBy("margin")
        calibration = curve.fit(
            points.agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("rows"))
        )
    return ToxicityModel(weights, trees, calibration, share)


def pin_features(sample: DataFrame, weights: dict[str, float]) -> DataFrame:
    made = sample.select("part", "label", vector_to_array(_feature_column(F.col("text"), weights)).alias("values"))
    return pin(made).df.select("part", "label", array_to_vector("values").alias("features"))


def _both_kinds(rows: DataFrame) -> bool:
    low, high = rows.agg(F.min("label"), F.max("label")).first()
    return low == 0.0 and high == 1.0


def _learn_words(sample: DataFrame, most: int) -> dict[str, float]:
    """Words and stems that more toxic documents hold, with their log-odds."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))

    def units(word: Column) -> Column:
        stems = [
            F.when(F.char_length(word) > k, F.concat(F.lit(STEM), F.substring(word, 1, k)))
            for k in STEM_LENGTHS
        ]
        return F.array_compact(F.array(word, *stems))

    units_of = F.array_distinct(F.flatten(F.transform(words, units)))
    sizes = sample.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count(F.lit(1))).first()
    toxic, clean = sizes[0], sizes[1] - sizes[0]
    if not toxic or not clean:
        return {}
    counts = (
        sample.select("label", F.explode(units_of).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    )
    t, c = F.col("t"), F.col("c")
    both = t + c
    # Twice the log-likelihood ratio of the two kinds of documents having two rates.
    ratio = 2 * (
        t * F.log(t * (toxic + clean) / (both * toxic))
        + F.when(c > 0, c * F.log(c * (toxic + clean) / (both * clean))).otherwise(0.0)
    )
    odds = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    best = (
        counts.where((t >= 3) & (t / toxic > c / clean))
        .select("word", ratio.alias("ratio"), odds.alias("odds"))
        .where("ratio > 20")
        .orderBy(F.desc("ratio"), "word")
        .limit(most)
    )
    return {row.word: row.odds for row in best.collect()}


def held_out() -> Column:
    """Whether a row is left out of learning, by doc_id."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return number % HELD_OUT_OF == 0


def query(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(~held_out()))
    return model.score(docs).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
