"""Quality scores from a regularised quadratic discriminant over text statistics."""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm.common import documents, whole
from ledgerline.llm.toxicity import held_out

THRESHOLD = 0.3
# Standard deviations beyond which a statistic counts no further.
CLIP = 5.0
# Shares of the pooled covariance, and then of a spherical one, that are tried.
POOLED, SPHERICAL = (0.05, 0.2, 0.5, 0.9), (0.01, 0.05, 0.2)
# Log odds are counted in steps, up to a largest.
_ODDS_STEP, _MOST_ODDS = 0.1, 40.0

FUNCTION_WORDS = frozenset(
    b"the of and to in is was for that with on as be by this are or from at not an it"
    b" le la les des du et est dans pour que qui un une sur pas par au"
    b" el los de que y en por para con las del se una como"
    b" der die das und zu den von mit im ein eine ist nicht des dem auf".split()
)

FEATURES = (
    "words",
    "word length",
    "spread of word length",
    "symbols",
    "sentence marks",
    "exclamations",
    "capitals",
    "digits",
    "other bytes",
    "distinct words",
    "most frequent word",
    "repeated neighbours",
    "function words",
    "words with symbols",
    "words in capitals",
    "compressed size",
    "words a line",
    "repeated lines",
)

# Kinds of bytes: rest, small letters, capitals, digits, sentence marks, other marks,
# bytes of other alphabets, exclamation marks.
_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate((b"", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:?'\"()-")):
    _KINDS[list(_bytes)] = _kind
_MARKS = rb"#$%&*+/<=>@[\]^_`{|}~"
_KINDS[list(_MARKS)] = 5
_KINDS[128:] = 6
_KINDS[ord("!")] = 7
_TO_MARK = bytes(1 if i in _MARKS else 0 for i in range(256))


def _share(part: float, total: float) -> float:
    """The log odds of a share, which spread it over the whole line."""
    return math.log((part + 0.5) / (max(total - part, 0.0) + 0.5))


def statistics(text: bytes) -> list[float]:
    """The statistics named in FEATURES of the UTF-8 bytes of a text."""
    words, lines = text.split(), text.split(b"\n")
    n, size = len(words), len(text)
    kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=8) if size else np.zeros(8)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    blank = size - int(lengths.sum())
    inked = size - blank
    marked = sum(1 for w in counts.elements() if 1 in w.translate(_TO_MARK)) if kinds[5] else 0
    shouted = sum(1 for w in words if len(w) > 1 and w.isupper()) if kinds[2] else 0
    return [
        math.log1p(n),
        math.log1p(lengths.mean()) if n else 0.0,
        math.log1p(lengths.std()) if n else 0.0,
        _share(kinds[5], inked),
        _share(kinds[4], inked),
        _share(kinds[7], inked),
        _share(kinds[2], inked),
        _share(kinds[3], inked),
        _share(kinds[6], inked),
        _share(len(counts), n),
        _share(max(counts.values(), default=0), n),
        _share(sum(map(eq, words, words[1:])), n),
        _share(sum(counts[w] for w in FUNCTION_WORDS), n),
        _share(marked, n),
        _share(shouted, n),
        _share(min(len(zlib.compress(text, 1)), size), size),
        math.log1p(n / len(lines)),
        _share(len(lines) - len(set(lines)), len(lines)),
    ]


def _statistics(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def compute(texts: pa.Array) -> pa.Array:
        rows = np.array([statistics(t.as_py()) for t in texts.cast(pa.binary())], np.float64)
        offsets = pa.array(np.arange(len(texts) + 1) * len(FEATURES), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))

    return compute(text)


@dataclass
class Moments:
    """Number, mean and covariance of the rows of one class."""

    n: float
    mean: np.ndarray
    covariance: np.ndarray


@dataclass
class Gaussian:
    """A class density by its mean and the Cholesky factor of its covariance."""

    mean: np.ndarray
    factor: np.ndarray
    log_weight: float

    def log_density(self, rows: np.ndarray) -> np.ndarray:
        white = np.linalg.solve(self.factor, (rows - self.mean).T)
        return self.log_weight - np.log(np.diag(self.factor)).sum() - np.square(white).sum(axis=0) / 2


def discriminant(classes: list[Moments], pooled: float, spherical: float) -> list[Gaussian]:
    """Densities of classes 0 and 1, with covariances shrunk in two steps.

    First by the share `pooled` towards the covariance within both classes, then by
    the share `spherical` towards a sphere of the same mean variance, which also makes
    it invertible.
    """
    total = sum(c.n for c in classes)
    within = sum(c.n * c.covariance for c in classes) / total
    found = []
    for c in classes:
        mixed = (1 - pooled) * c.covariance + pooled * within
        level = max(np.trace(mixed) / len(mixed), 1e-6)
        shrunk = (1 - spherical) * mixed + spherical * level * np.eye(len(mixed))
        found.append(Gaussian(c.mean, np.linalg.cholesky(shrunk), math.log(c.n / total)))
    return found


def log_odds(densities: list[Gaussian], rows: np.ndarray) -> np.ndarray:
    return densities[1].log_density(rows) - densities[0].log_density(rows)


class QualityModel:
    """What `fit` learned; `score` adds the column `quality`."""

    def __init__(self, share: float, center=None, spread=None, densities=None, slope=1.0, shift=0.0):
        self.share = share
        self.center, self.spread = center, spread
        self.densities = densities
        self.slope, self.shift = slope, shift

    def score(self, rows: DataFrame) -> DataFrame:
        """All columns of `rows`, which has `statistics`, with `quality` from 0 to 1.

        A column named quality gives way. Rows, also repeated ones, are scored one by
        one.
        """
        if self.densities is None:
            return rows.withColumn("quality", F.lit(self.share))
        return rows.withColumn("quality", self._probability()(F.col("statistics")))

    def _probability(self):
        center, spread, densities = self.center, self.spread, self.densities
        slope, shift = self.slope, self.shift

        @F.arrow_udf("double")
        def compute(values: pa.Array) -> pa.Array:
            odds = log_odds(densities, _standard(values, center, spread))
            odds = np.clip(odds, -_MOST_ODDS, _MOST_ODDS)
            return pa.array(1 / (1 + np.exp(-(slope * odds + shift))))

        return compute


def _standard(values: pa.Array, center: np.ndarray, spread: np.ndarray) -> np.ndarray:
    rows = values.flatten().to_numpy().reshape(len(values), len(FEATURES))
    return np.clip((rows - center) / spread, -CLIP, CLIP)


def with_statistics(docs: DataFrame) -> DataFrame:
    """All columns of `docs`, with `statistics` of the text; null is empty.

    A column of that name gives way.
    """
    return docs.withColumn("statistics", _statistics(whole(F.col("text"))))


def fit(rows: DataFrame, labels: DataFrame, seed: int = 5) -> QualityModel:
    """Learn from the statistics of labelled documents.

    `rows` has doc_id and statistics, `labels` doc_id and quality (0 or 1); label rows
    with a null in either are left out, and a doc_id labelled twice is good if one
    label says so. All labelled documents are learned from: numbers, sums and products
    are added up where the rows are, and the driver gets one set of them. Four fifths
    (by a hash of doc_id) make the densities; the rest choose the shrinkage and the
    slope and shift that turn log odds into a probability, so neither is judged by what
    it was made from. Without labels of both kinds in each part every score is the share
    of good labels, or 0.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
    )
    part = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(5))
    known = pin(rows.select("doc_id", "statistics").join(marked, "doc_id").select("statistics", "label", part.alias("part"))).df
    n = {(r["own"], r["label"]): r["n"] for r in known.groupBy((F.col("part") < 4).alias("own"), "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, total = sum(v for k, v in n.items() if k[1]), sum(n.values())
    if len(n) < 4:
        return QualityModel(good / total if total else 0.0)
    own, rest = known.where("part < 4"), known.where("part = 4")
    zero, one = np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    all_own = _moments(own.withColumn("label", F.lit(0)), zero, one, math.inf)[0]
    center, spread = all_own.mean, np.sqrt(np.maximum(np.diag(all_own.covariance), 1e-6))
    classes = _moments(own, center, spread, CLIP)
    tried = [discriminant([classes[0], classes[1]], p, s) for p in POOLED for s in SPHERICAL]
    best = min((_calibrated(c) + (i,) for i, c in _odds_counts(rest, tried, center, spread).items()))
    _, slope, shift, number = best
    return QualityModel(good / total, center, spread, tried[number], slope, shift)


def _moments(rows: DataFrame, center: np.ndarray, spread: np.ndarray, clip: float) -> dict[int, Moments]:
    """Moments per label, from sums that every task makes of its rows."""
    d = len(FEATURES)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, d)
            x = np.clip((values - center) / spread, -clip, clip)
            labels = batch.column(1).to_numpy()
            for label in np.unique(labels).tolist():
                own = x[labels == label]
                new = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                sums[label] = sums.get(label, 0) + new
        for label, values in sums.items():
            columns = [np.full(len(values), label, np.int32), np.arange(len(values), dtype=np.int32), values]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["label", "place", "value"])

    summed = (
        rows.select("statistics", "label")
        .mapInArrow(parts, "label int, place int, value double")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    found = {}
    for label in {r["label"] for r in summed}:
        values = np.zeros(1 + d + d * d)
        for r in summed:
            if r["label"] == label:
                values[r["place"]] = r["value"]
        n, mean = values[0], values[1 : 1 + d] / values[0]
        found[label] = Moments(n, mean, values[1 + d :].reshape(d, d) / n - np.outer(mean, mean))
    return found


def _odds_counts(rows: DataFrame, tried: list, center: np.ndarray, spread: np.ndarray) -> dict[int, np.ndarray]:
    """For each discriminant, how many rows of each label have which log odds."""
    steps = int(2 * _MOST_ODDS / _ODDS_STEP) + 1

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(tried), 2, steps), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _standard(batch.column(0), center, spread)
            labels = batch.column(1).to_numpy()
            for number, densities in enumerate(tried):
                odds = np.clip(log_odds(densities, x), -_MOST_ODDS, _MOST_ODDS)
                step = np.rint((odds + _MOST_ODDS) / _ODDS_STEP).astype(np.int64)
                np.add.at(counts[number], (labels, step), 1)
        found = np.argwhere(counts)
        columns = [*found.T, counts[tuple(found.T)]]
        names = ["number", "label", "step", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    summed = rows.select("statistics", "label").mapInArrow(parts, "number long, label long, step long, n long")
    counts = {number: np.zeros((2, steps)) for number in range(len(tried))}
    # Discriminants times labels times steps, whatever the number of rows.
    for r in summed.groupBy("number", "label", "step").agg(F.sum("n").alias("n")).collect():
        counts[r["number"]][r["label"], r["step"]] = r["n"]
    return counts


def _calibrated(counts: np.ndarray) -> tuple[float, float, float]:
    """Log loss, slope and shift of the logistic curve that fits the counts best."""
    odds = np.arange(counts.shape[1]) * _ODDS_STEP - _MOST_ODDS
    design = np.stack([odds, np.ones_like(odds)])
    total, good = counts.sum(axis=0), counts[1]
    beta = np.array([0.0, math.log((good.sum() + 1) / (counts[0].sum() + 1))])

    def loss(beta: np.ndarray) -> float:
        z = beta @ design
        # The small term keeps the curve finite where both labels are apart.
        return float(np.logaddexp(0, -z) @ good + np.logaddexp(0, z) @ counts[0] + beta[0] ** 2 / 2)

    now = loss(beta)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(beta @ design)))
        gradient = design @ (good - total * p) - np.array([beta[0], 0.0])
        curvature = (design * (total * p * (1 - p))) @ design.T + np.diag([1.0, 1e-6])
        step = np.linalg.solve(curvature, gradient)
        while loss(beta + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        beta, before, now = beta + step, now, loss(beta + step)
        if before - now < 1e-9:
            break
    return now / total.sum(), float(beta[0]), float(beta[1])


def query(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = pin(with_statistics(docs).select("doc_id", "statistics")).df
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(rows, labels.where(~held_out()))
    return model.score(rows).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality").alias("score"),
        (F.col("quality") >= THRESHOLD).cast("int").alias("predicted"),
    )
