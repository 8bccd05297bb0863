"""Scores of texts under a hashed maximum-entropy language model."""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.joins import apart
from ledgerline.functions.pinning import pin
from ledgerline.llm.common import documents, whole

# Words that are at least this share of all training tokens go to every task, so
# there are at most 1/HEAD_SHARE of them. Others meet their counts in a join.
HEAD_SHARE = 2e-6
# The softmax has CLASSES classes. The most frequent words fill OWN of them, WORDS in
# each; the others share one class for each of the most frequent endings, of ENDING
# bytes, and one for all other endings.
CLASSES = WORDS = 64
OWN, ENDING = 16, 2
# Rows of the two tables of hashed feature weights: a power of two.
ROWS = 1 << 14
FEATURES = 4
# Each round learns from all tokens of its share of the training texts.
ROUNDS = 2
# The length of a step, and what holds back features that were seen seldom.
RATE, CAUTION = 0.3, 3.0
BATCH = 4096
# Rows of a batch with more equal features than that are summed one feature at a time.
LONG_RUN = 8
# Tokens scored at once, and different words counted before they are passed on.
CHUNK, MOST_COUNTED = 1 << 16, 500_000
# Rows of weights that are summed together, and learners summed in one step.
SLICE, FAN_IN = 512, 64

END = b""
_NEVER = np.float32(-1e9)


class Vocabulary:
    """Counts of the training tokens: all of them, the head's, the modelled words'.

    `head` has the frequent words with their counts, `endings` the tokens and the
    distinct words of each ending.
    """

    def __init__(
        self, head: list[tuple[bytes, int]], tokens: int, endings: list[tuple[bytes, int, int]]
    ):
        head = sorted(head, key=lambda x: (x[0] != END, -x[1], x[0]))
        self.ids = {word: i for i, (word, _) in enumerate(head)}
        self.counts = np.array([c for _, c in head], np.int64)
        self.tokens, self.distinct = tokens, sum(d for _, _, d in endings)
        self.modelled = min(len(head), OWN * WORDS)
        # In a shared class a word counts once more than seen, and one stands for all unseen.
        left = {ending: n + distinct for ending, n, distinct in endings}
        for word, n in head[: self.modelled]:
            left[word[-ENDING:]] -= n + 1
        named = sorted(left, key=lambda ending: (-left[ending], ending))[: CLASSES - OWN - 1]
        self.shared = {ending: OWN + i for i, ending in enumerate(named)}
        self.rest = np.ones(CLASSES, np.int64)
        for ending, n in left.items():
            self.rest[self.shared.get(ending, CLASSES - 1)] += n
        # Symbols are the words of the head, then the classes of other words, then a start.
        self.start = len(head) + CLASSES
        classes = [
            i // WORDS if i < self.modelled else self.shared_class(word)
            for i, (word, _) in enumerate(head)
        ]
        self.classes = np.array([*classes, *range(CLASSES), 0], np.int64)
        # What a symbol is to the words after it: the word if it is modelled, else its class.
        self.contexts = self.modelled + self.classes
        self.contexts[: self.modelled] = np.arange(self.modelled)
        self.contexts[self.start] = self.modelled + CLASSES
        words = np.full((CLASSES, WORDS), _NEVER)
        words.flat[: self.modelled] = np.log(np.maximum(self.counts[: self.modelled], 1))
        sums = np.log(np.exp(words, dtype=np.float64).sum(axis=1) + 1e-300)
        self.word_offsets = np.where(words > _NEVER, words - sums[:, None], _NEVER).astype(np.float32)
        used = -(-self.modelled // WORDS)
        sums[used:OWN] = _NEVER
        sums[OWN:] = np.log(self.rest[OWN:])
        sums[OWN + len(named) : CLASSES - 1] = _NEVER
        self.class_offsets = sums.astype(np.float32)

    def shared_class(self, word: bytes) -> int:
        return self.shared.get(word[-ENDING:], CLASSES - 1)

    def symbols(self, words: list[bytes]) -> list[int]:
        get, other = self.ids.get, len(self.ids)
        shared, last = {e: other + c for e, c in self.shared.items()}.get, other + CLASSES - 1
        # The symbol 0 is END, which no word is.
        return [get(word) or shared(word[-ENDING:], last) for word in words]


def _hashed(kind: int, *values: np.ndarray) -> np.ndarray:
    mixed = np.full(len(values[0]), kind + 1, np.uint64)
    for value in values:
        mixed = (mixed ^ value.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed & np.uint64(ROWS - 1)).astype(np.int64)


def features(contexts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of the features before each place: two n-grams and two skips."""
    one, two, three = contexts[at - 1], contexts[at - 2], contexts[at - 3]
    return np.stack(
        [_hashed(0, one), _hashed(1, one, two), _hashed(2, two), _hashed(3, three)], axis=1
    )


def _softmax(scores: np.ndarray) -> np.ndarray:
    """Probabilities, in place of `scores`."""
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _log_at(scores: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Logs of the probabilities of `targets`; overwrites `scores`."""
    scores -= scores.max(axis=1, keepdims=True)
    found = scores[np.arange(len(targets)), targets]
    np.exp(scores, out=scores)
    return found - np.log(scores.sum(axis=1))


def _sum_of_rows(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = weights.take(rows[:, 0], axis=0)
    for i in range(1, FEATURES):
        total += weights.take(rows[:, i], axis=0)
    return total


def _sum_runs(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows of values[order] from each start to the next."""
    lengths = np.diff(starts, append=len(order))
    sums = values.take(order[starts], axis=0)
    for run in np.flatnonzero(lengths > LONG_RUN):
        own = order[starts[run] : starts[run] + lengths[run]]
        sums[run] = np.add.reduce(values.take(own, axis=0), axis=0)
    short = np.flatnonzero((lengths > 1) & (lengths <= LONG_RUN))
    nth = 1
    while len(short):
        sums[short] += values.take(order[starts[short] + nth], axis=0)
        nth += 1
        short = short[lengths[short] > nth]
    return sums


class Model:
    """Weights of the features for classes, and for words within a class."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray | None = None):
        self.vocabulary = vocabulary
        if weights is None:
            weights = np.zeros((2 * ROWS, WORDS), np.float32)
        self.weights = weights

    def _classes(self, rows: np.ndarray) -> np.ndarray:
        scores = _sum_of_rows(self.weights, rows)
        scores += self.vocabulary.class_offsets
        return scores

    def _words(self, rows: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        of_class = ((rows * 31 + classes[:, None] * 7919) & (ROWS - 1)) + ROWS
        scores = _sum_of_rows(self.weights, of_class)
        scores += self.vocabulary.word_offsets.take(classes, axis=0)
        return scores, of_class

    def score(self, ids: np.ndarray, contexts: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each modelled word, or of the class of others."""
        rows = features(contexts, at)
        target = ids[at]
        classes = self.vocabulary.classes[target]
        found = _log_at(self._classes(rows), classes).astype(np.float64)
        own = np.flatnonzero(target < self.vocabulary.modelled)
        if len(own):
            words, _ = self._words(rows[own], classes[own])
            found[own] += _log_at(words, target[own] % WORDS)
        return found

    def learn(
        self, ids: np.ndarray, contexts: np.ndarray, at: np.ndarray, squares: np.ndarray
    ) -> None:
        """One gradient step per feature row on a batch, scaled by past gradients."""
        rows = features(contexts, at)
        target = ids[at]
        classes = self.vocabulary.classes[target]
        missed = _softmax(self._classes(rows))
        missed[np.arange(len(at)), classes] -= 1
        changes = [(rows, missed)]
        own = np.flatnonzero(target < self.vocabulary.modelled)
        if len(own):
            words, of_class = self._words(rows[own], classes[own])
            missed = _softmax(words)
            missed[np.arange(len(own)), target[own] % WORDS] -= 1
            changes.append((of_class, missed))
        for rows, missed in changes:
            # Short integers are sorted by radix.
            flat = rows.ravel().astype(np.uint16)
            order = np.argsort(flat, kind="stable")
            starts = np.flatnonzero(np.diff(flat[order].astype(np.int64), prepend=-1))
            touched = flat[order[starts]]
            step = _sum_runs(missed, order // FEATURES, starts)
            squares[touched] += np.einsum("ij,ij->i", step, step) / step.shape[1]
            step *= RATE / np.sqrt(squares[touched, None] + CAUTION)
            self.weights[touched] -= step


def _split(text: bytes) -> list[bytes]:
    return text.lower().split()


def token_counts(texts: DataFrame) -> DataFrame:
    """Occurrences of every token of column `text`: word, count. END is b""."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                counts.update(_split(text.as_py()))
                counts[END] += 1
                if len(counts) >= MOST_COUNTED:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    found = texts.select("text").mapInArrow(parts, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array(list(counts), pa.binary())
    return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])


def _encode(vocabulary: Vocabulary, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list]:
    """Symbols of all texts, each behind three starts and before an end; its words."""
    (end,) = vocabulary.symbols([END]) if not vocabulary.ids else (0,)
    ids, ends, words = [], [], []
    for text in texts:
        found = _split(text)
        words.append(found)
        ids += (vocabulary.start, vocabulary.start, vocabulary.start)
        ids += vocabulary.symbols(found)
        ids.append(end)
        ends.append(len(ids))
    return np.array(ids, np.int64), np.array(ends, np.int64), words


def _in_chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch, with the number of the first, some thousand tokens at a time."""
    chunk: list[bytes] = []
    first = size = 0
    for number, text in enumerate(batch.column(column).cast(pa.binary())):
        chunk.append(text.as_py())
        size += len(chunk[-1])
        if size >= 6 * CHUNK:
            yield first, chunk
            chunk, first, size = [], number + 1, 0
    if chunk:
        yield first, chunk


def _learner(vocabulary: Vocabulary, weights: np.ndarray, seed: int):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(vocabulary, weights.copy())
        squares = np.zeros(2 * ROWS, np.float32)
        for batch in batches:
            for _, texts in _in_chunks(batch, "text"):
                ids, _, _ = _encode(vocabulary, texts)
                contexts = vocabulary.contexts[ids]
                at = np.flatnonzero(ids != vocabulary.start)
                at = np.random.default_rng(seed).permutation(at)
                for start in range(0, len(at), BATCH):
                    model.learn(ids, contexts, at[start : start + BATCH], squares)
        change = np.column_stack([model.weights - weights, squares > 0]).astype("<f4")
        leaf = TaskContext.get().partitionId()
        for number in range(0, len(change), SLICE):
            part = change[number : number + SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([leaf]), pa.array([part.tobytes()])],
                    names=["slice", "leaf", "change"],
                )

    return parts


def _sum_changes(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), "<f4").astype(np.float64) for x in table.column("change"))
    first = table.slice(0, 1)
    return first.set_column(2, "change", pa.array([total.astype("<f4").tobytes()]))


def train(vocabulary: Vocabulary, texts: DataFrame, seed: int = 3) -> Model:
    """Learn from column `text`, in rounds, each from a share of the texts of its own.

    In a round every task takes gradient steps on its texts, starting from the model
    of the round before; the changes of a row of weights are averaged over the tasks
    that saw its feature. They are summed slice by slice in a tree, so nothing of the
    size of all models together meets anywhere; the driver gets one model.
    """
    model = Model(vocabulary)
    schema = "slice long, leaf long, change binary"
    for turn in range(ROUNDS):
        share = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(ROUNDS)) == turn
        mine = texts.where(share).select("text")
        changes = mine.mapInArrow(_learner(vocabulary, model.weights, seed + turn), schema)
        learners = mine.rdd.getNumPartitions()
        while True:
            merged = changes.withColumn("leaf", F.expr(f"leaf div {FAN_IN}"))
            changes = merged.groupBy("slice", "leaf").applyInArrow(_sum_changes, schema)
            learners = -(-learners // FAN_IN)
            if learners == 1:
                break
        weights = model.weights.copy()
        for row in changes.collect():
            change = np.frombuffer(row["change"], "<f4").reshape(-1, WORDS + 1)
            own = slice(row["slice"], row["slice"] + len(change))
            weights[own] += change[:, :WORDS] / np.maximum(change[:, WORDS:], 1)
        model = Model(vocabulary, weights)
    return model


def _scorer(model: Model):
    vocabulary = model.vocabulary
    base = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    in_rest = np.log10(vocabulary.rest)
    plus_one = np.append(np.log10(vocabulary.counts + 1), np.zeros(CLASSES + 1))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in range(5)]
            for _, texts in _in_chunks(batch, "text"):
                for values, found in zip(columns, _score(texts), strict=True):
                    values.extend(found)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            arrays = [pa.array(v, k) for v, k in zip(columns[:4], kinds, strict=True)]
            arrays.append(_pairs(columns[4]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *arrays],
                names=["doc_id", "hash1", "hash2", "n_tokens", "n_known", "base", "model", "tail"],
            )

    def _score(texts: list[bytes]) -> tuple:
        ids, ends, words = _encode(vocabulary, texts)
        start, contexts = vocabulary.start, vocabulary.contexts[ids]
        values = np.zeros((3, len(ids)))
        at = np.flatnonzero(ids != start)
        for first in range(0, len(at), BATCH):
            some = at[first : first + BATCH]
            values[0, some] = model.score(ids, contexts, some) / math.log(10)
        known = (ids < len(vocabulary.ids)).astype(np.int64)
        values[1] = np.where(ids == start, 0, plus_one[ids] - base)
        # Words of shared classes: their share of it, but for what counts of the tail add.
        other = (ids >= vocabulary.modelled) & (ids != start)
        values[2] = np.where(other, plus_one[ids] - in_rest[vocabulary.classes[ids]], 0)
        starts = np.append(0, ends[:-1])
        sums = np.add.reduceat(values, starts, axis=1)
        rare = [Counter([w for w in found if w not in vocabulary.ids]) for found in words]
        return (
            [len(w) + 1 for w in words],
            np.add.reduceat(known, starts).tolist(),
            sums[1].tolist(),
            (sums[0] + sums[2]).tolist(),
            rare,
        )

    return parts


def _pairs(counters: list[Counter]) -> pa.ListArray:
    """Each counter as a list of (word, n)."""
    words = pa.array([w for c in counters for w in c], pa.binary())
    numbers = pa.array([n for c in counters for n in c.values()], pa.int64())
    ends = np.cumsum([0, *map(len, counters)], dtype=np.int32)
    pairs = pa.StructArray.from_arrays([words, numbers], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


def lm_scores(docs: DataFrame, training: Column) -> DataFrame:
    """Log-probabilities (base 10) of all texts, learning where `training` is true.

    Returns doc_id, n_tokens, n_known (tokens that training has), train_tokens,
    base_score and score. Tokens are words with A-Z lowered, and an end.
    `base_score` adds one to every count; `score` is the model's: a class given the
    two words before, alone and together, and two skipped ones, times a word of the
    class given the same. The most frequent words have classes of their own; other
    words share a class with those of the same ending, in which they are drawn by
    their counts plus one, and stand for that class where they precede a word.

    Counts cover all training texts and meet each text exactly: those of frequent
    words in the tasks, those of the others in a join with what a text has of them.
    Scores depend on the text alone. A null text is empty, just an end; a null in
    `training` is false. Without training texts every score is 0. Rows that are equal
    give equal rows; other columns are not looked at; an empty table gives none.
    """
    text = whole(F.col("text"))
    rows = docs.select(
        "doc_id",
        F.xxhash64(text).alias("hash1"),
        F.xxhash64(F.lit("second"), text).alias("hash2"),
        text.alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
    )
    learned = rows.where("training").select("text")
    counts = pin(token_counts(learned))
    tokens = counts.df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_head = (F.col("n") >= HEAD_SHARE * tokens) | (F.octet_length("word") == 0)
    head = [(bytes(r["word"]), r["n"]) for r in counts.df.where(is_head).collect()]
    by_ending = counts.df.groupBy(F.expr(f"substring(word, -{ENDING}, {ENDING})").alias("ending"))
    # As many as there are strings of two bytes at most.
    endings = by_ending.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).collect()
    endings = [(bytes(r["ending"]), r["n"], r["distinct"]) for r in endings]
    vocabulary = Vocabulary(head, tokens, endings)
    model = train(vocabulary, learned) if head else Model(vocabulary)
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {doc_kind}, hash1 long, hash2 long, n_tokens long, n_known long, base double,"
        " model double, tail array<struct<word: binary, n: long>>"
    )
    scored = rows.select("doc_id", "hash1", "hash2", "text").mapInArrow(_scorer(model), schema)
    scored = pin(scored).df
    # Equal texts add the same to each sum, and divide it by their number.
    keys = ["hash1", "hash2"]
    tails = scored.select(*keys, F.explode("tail").alias("t")).select(*keys, "t.word", "t.n")
    rare = counts.df.where(~is_head).select("word", F.col("n").alias("seen"))
    found = tails.join(rare, "word", "left")
    added = found.groupBy(*keys).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("seen", F.lit(0)) + 1)).alias("logs"),
        F.sum(F.when(F.col("seen") > 0, F.col("n")).otherwise(0)).alias("known"),
    )
    times = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    per_text = (
        times.join(added, keys, "left")
        .groupBy(*apart(*keys))
        .agg(*(F.first(c).alias(c) for c in ("times", "logs", "known")))
        .drop("group_hash")
    )
    logs = F.coalesce(F.col("logs") / F.col("times"), F.lit(0.0))
    known = F.coalesce(F.col("known") / F.col("times"), F.lit(0.0)).cast("long")
    return scored.drop("tail").join(per_text, keys).select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + known).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )


def held_out() -> Column:
    """Whether a document is left out of learning, by doc_id."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return number % 7 == 2


def query(spark, sf_dir) -> DataFrame:
    scores = lm_scores(documents(spark, sf_dir), ~held_out())
    return scores.withColumn("held_out", held_out())
