"""Training passages that hold benchmark items, found with BM25 and block-max WAND."""

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm.common import documents, whole

K1, B = 1.2, 0.75
# Least BM25 score of a passage, as a share of what the item itself scores.
LEAST_SCORE = 0.6
# Least overlap of the question and of the answer.
LEAST_OVERLAP = 0.8
SHINGLE = 5
# Items of one index, and bytes of their texts. A larger benchmark has several, each asked by all passages.
INDEX_ITEMS = 8192
INDEX_BYTES = 16 << 20
# Postings of a block, and groups of items in the first, rough bound.
BLOCK = 16
GROUPS = 32
# Tokens that the rough bound is computed for at once.
CHUNK = 100_000

_TOKEN = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.!?]+\s+(?=\S)")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def answer_start(text: str) -> int:
    """Number of the first token of the answer.

    The answer is what follows the last question mark, else the last sentence, else
    the last quarter of the words.
    """
    words = tokens(text)
    asked = text.rfind("?") + 1
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    cut = asked if asked and tokens(text[asked:]) else (ends[-1] if ends else 0)
    first = len(tokens(text[:cut])) if cut else 0
    return first if 0 < first < len(words) else max(len(words) - max(1, len(words) // 4), 0)


def weights(items: DataFrame) -> DataFrame:
    """The postings of an inverted index: term, item_id and BM25 weight.

    A weight is divided by what the item scores with all its own terms, so that one
    threshold fits all items. `items` has item_id and text without nulls.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*batch.columns, strict=True):
                words = tokens(text.as_py())
                if words:
                    found, counts = np.unique(np.array(words, object), return_counts=True)
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item.as_py()] * n, item.type),
                            pa.array(found, pa.string()),
                            pa.array(counts, pa.int64()),
                            pa.array([len(words)] * n, pa.int64()),
                        ],
                        names=["item_id", "term", "tf", "length"],
                    )

    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, term string, tf long, length long"
    postings = pin(items.select("item_id", "text").mapInArrow(parts, schema)).df
    lengths = postings.groupBy("item_id").agg(F.first("length").alias("length"))
    number, mean = lengths.agg(F.count(F.lit(1)), F.avg("length")).first()
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(number) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf")
    damped = tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0)))
    scored = postings.join(frequency, "term").select("item_id", "term", (idf * damped).alias("w"))
    own = scored.groupBy("item_id").agg(F.sum("w").alias("own"))
    return scored.join(own, "item_id").select(
        "item_id", "term", (F.col("w") / F.col("own")).alias("weight")
    )


class Index:
    """An inverted index in blocks, with the largest weight of each.

    `postings` are (term, item number, weight); `items` the tokens of each item and
    where its answer starts.
    """

    def __init__(self, postings: list[tuple], items: list[tuple[list[str], int]]):
        self.items = items
        self.span = max((len(words) for words, _ in items), default=1)
        self.shingles = [_shingles(words) for words, _ in items]
        by_term: dict[str, list] = {}
        for term, item, weight in sorted(postings):
            by_term.setdefault(term, []).append((item, weight))
        self.vocabulary = {term: i for i, term in enumerate(by_term)}
        self.lists = []
        self.rough = np.zeros((len(by_term), GROUPS), np.float32)
        for number, entries in enumerate(by_term.values()):
            ids = [item for item, _ in entries]
            scores = [weight for _, weight in entries]
            blocks = range(0, len(ids), BLOCK)
            self.lists.append(
                (
                    ids,
                    scores,
                    max(scores),
                    [max(scores[at : at + BLOCK]) for at in blocks],
                    [ids[min(at + BLOCK, len(ids)) - 1] for at in blocks],
                )
            )
            groups = np.array(ids) * GROUPS // max(1, len(items))
            np.maximum.at(self.rough[number], groups, np.array(scores, np.float32))

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All items that score at least `least` for the terms, by block-max WAND."""
        lists = [self.lists[t] for t in terms]
        at = [0] * len(lists)
        live = list(range(len(lists)))
        found = []

        def here(i: int) -> int:
            return lists[i][0][at[i]]

        def advance(chosen: list[int], item: int) -> None:
            for i in chosen:
                at[i] = bisect_left(lists[i][0], item, at[i])

        while live:
            live = [i for i in live if at[i] < len(lists[i][0])]
            live.sort(key=here)
            bound, pivot = 0.0, None
            for place, i in enumerate(live):
                bound += lists[i][2]
                if bound >= least:
                    pivot = place
                    break
            if pivot is None:
                break
            item = here(live[pivot])
            while pivot + 1 < len(live) and here(live[pivot + 1]) == item:
                pivot += 1
            upto = live[: pivot + 1]
            # The bound from the blocks in which the item would stand.
            bound, ends = 0.0, []
            for i in upto:
                block = bisect_left(lists[i][4], item, at[i] // BLOCK)
                if block < len(lists[i][4]):
                    bound += lists[i][3][block]
                    ends.append(lists[i][4][block] + 1)
            if bound < least:
                following = here(live[pivot + 1]) if pivot + 1 < len(live) else None
                advance(upto, max(item + 1, min([*ends, *([following] if following is not None else [])], default=item + 1)))
            elif here(upto[0]) == item:
                score = sum(lists[i][1][at[i]] for i in upto)
                if score >= least:
                    found.append((item, score))
                advance(upto, item + 1)
            else:
                advance([i for i in upto if here(i) < item], item)
        return found

    def overlaps(self, item: int, words: list[str]) -> tuple[float, float]:
        """Overlap of a passage with the item's question and with its answer.

        Of the question, the share of words in a shingle that the passage holds; of
        the answer, the share of different words that it holds.
        """
        own, answer = self.items[item]
        held = set(_shingles(words, min(SHINGLE, len(own))))
        covered = np.zeros(len(own), bool)
        for at, shingle in enumerate(self.shingles[item]):
            if shingle in held:
                covered[at : at + len(shingle)] = True
        part = set(own[answer:])
        question = covered[:answer].mean() if answer else covered.mean()
        return float(question), len(part.intersection(words)) / len(part)

    def hits(self, texts: list[str], least: float, overlap: float) -> Iterator[tuple]:
        """(text number, item, score, overlaps, passage) of verified items.

        A text is cut into stretches as long as the longest item, and a passage is
        two neighbouring stretches, so every item lies within one. For all passages
        the largest weights per group of items are summed first; only those passages
        where a group reaches `least` are searched.
        """
        known, lengths = [], []
        for text in texts:
            words = tokens(text)
            ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
            known.append(ids)
            lengths.append(len(words) // self.span + 1)
        first = np.concatenate([[0], np.cumsum(lengths)])
        stretch = [
            first[n] + np.arange(len(ids)) // self.span for n, ids in enumerate(known)
        ]
        ids, stretch = np.concatenate(known), np.concatenate(stretch)
        size = max(1, len(self.vocabulary))
        pairs = np.unique((stretch * size + ids)[ids >= 0])
        if not len(pairs):
            return
        stretch, term = pairs // size, pairs % size
        starts = np.flatnonzero(np.diff(stretch, prepend=-1))
        bounds = np.zeros((int(first[-1]) + 1, GROUPS), np.float32)
        bounds[stretch[starts]] = np.add.reduceat(self.rough[term], starts)
        two = bounds[:-1] + bounds[1:]
        # Float sums in another order may lie a little lower.
        for place in np.flatnonzero(two.max(axis=1) >= least * (1 - 1e-4)):
            number = int(np.searchsorted(first, place, "right")) - 1
            at = (int(place) - int(first[number])) * self.span
            ids = known[number][at : at + 2 * self.span]
            terms = np.unique(ids[ids >= 0]).tolist()
            words = None
            for item, score in self.search(terms, least):
                words = words or tokens(texts[number])[at : at + 2 * self.span]
                question, answer = self.overlaps(item, words)
                if question >= overlap and answer >= overlap:
                    yield number, item, score, question, answer, at


def _shingles(words: list[str], width: int = SHINGLE) -> list[tuple[str, ...]]:
    width = min(width, len(words))
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least_score: float = LEAST_SCORE,
    least_overlap: float = LEAST_OVERLAP,
    index_items: int = INDEX_ITEMS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per document and benchmark item that it holds.

    Columns doc_id, text_hash (tells rows with one doc_id apart), item_id, score (BM25
    over the item's own score), question_overlap, answer_overlap and passage (number
    of its first word). Every passage of every whole text is a query against an index
    of the items; what scores `least_score` or more is kept if question and answer
    overlap by `least_overlap` or more. Of several passages the best counts.

    An index of about `index_items` items, and `index_bytes` of their texts, goes to all
    tasks. A larger benchmark is cut into as many indexes as that needs, by a hash of the
    item. Each sees all documents, and its results are stored before the next is made, so
    the driver holds one index at a time.

    Null texts are empty; items without words are in no document. A null doc_id or
    item_id is kept as it is. Rows that repeat a doc_id each count, equal ones give
    one row, and so do equal item_ids with equal texts. Other columns are not looked
    at. Empty tables give no rows.
    """
    items = benchmark.select("item_id", whole(F.col("text")).alias("text")).distinct()
    items = items.where(F.col("text").rlike(r"[\p{L}\p{N}_]"))
    # Numbers for items: ids may be null or repeated.
    numbered = items.withColumn("key", F.xxhash64("item_id", "text"))
    stored = pin(numbered)
    postings = pin(weights(stored.df.select(F.col("key").alias("item_id"), "text"))).df
    parts = max(-(-stored.rows // index_items), -(-stored.bytes // index_bytes))
    rows = docs.select("doc_id", whole(F.col("text")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, text_hash long, key long, score double, question_overlap double,"
        " answer_overlap double, passage long"
    )
    found = docs.sparkSession.createDataFrame([], schema)
    for part in range(parts):
        mine = F.pmod("key", F.lit(parts)) == part
        own = stored.df.where(mine).orderBy("key").select("key", "text").collect()
        number = {row.key: i for i, row in enumerate(own)}
        entries = [
            (row.term, number[row.item_id], row.weight)
            for row in postings.where(F.pmod("item_id", F.lit(parts)) == part).collect()
        ]
        index = ([row.key for row in own], entries, [(tokens(r.text), answer_start(r.text)) for r in own])
        found = found.union(pin(rows.mapInArrow(_search(index, least_score, least_overlap), schema)).df)
    best = found.groupBy("doc_id", "text_hash", "key").agg(
        F.max(F.struct("score", "question_overlap", "answer_overlap", -F.col("passage"))).alias("best")
    )
    named = best.join(stored.side.select("key", "item_id"), "key")
    return named.select(
        "doc_id",
        "text_hash",
        "item_id",
        "best.score",
        "best.question_overlap",
        "best.answer_overlap",
        (-F.col("best.col4")).alias("passage"),
    )


def _search(index: tuple, least: float, overlap: float):
    keys, postings, items = index

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = Index(postings, items)
        for part in parts:
            texts = part.column("text")
            start, size = 0, 0
            for end in range(1, len(texts) + 1):
                # A token takes two characters at least, here about six.
                size += len(texts[end - 1].as_buffer() or b"") // 6
                if size >= CHUNK or end == len(texts):
                    yield from _found(part.slice(start, end - start), searched)
                    start, size = end, 0

    def _found(part: pa.RecordBatch, searched: Index) -> Iterator[pa.RecordBatch]:
        hits = list(searched.hits(part.column("text").to_pylist(), least, overlap))
        if hits:
            rows, which, *values = zip(*hits, strict=True)
            ids = [part.column(c).take(pa.array(rows)) for c in ("doc_id", "text_hash")]
            found = [pa.array([keys[i] for i in which], pa.int64())]
            found += [pa.array(v, pa.float64()) for v in values[:3]]
            found.append(pa.array(values[3], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*ids, *found],
                names=["doc_id", "text_hash", "key", "score", "question_overlap", "answer_overlap", "passage"],
            )

    return batches


def query(spark, sf_dir) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(documents(spark, sf_dir), benchmark).drop("text_hash")
