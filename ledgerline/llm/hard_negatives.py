"""Hard negatives of anchors, by vertical scans of vector blocks under bounds."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.pinning import Pinned, broadcast_limit, pin

# Components in a block of rows (2 MB), and anchors in a block of them.
BLOCK_VALUES, ANCHORS = 1 << 18, 1024
# Dimensions that are read between two looks at the bounds.
STEP = 8
SCALE = 256.0
# Sums of products below this are exact in doubles.
EXACT = 2.0**53

# Of the contract.
POSITIVES = NEGATIVES = 5
LOWEST = 80

_BLOCK = "block long, size int, dims int, ids array<long>, labels array<long>, data binary"
_OF_BLOCK = [field.split()[0] for field in _BLOCK.split(", ")]
_ANCHOR = "block long, place int, anchor_id long, label long, data binary"


def pack_vectors(rows: DataFrame) -> Pinned:
    """Blocks of vectors by dimension, from vec_id, label and embedding.

    Components are 256 times as large and rounded down. Rows with a null label, a null
    vector or a component that is null or not finite are left out.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            vectors = np.floor(_matrix(batch.column(2)) * SCALE)
            whole = np.flatnonzero(np.isfinite(vectors).all(axis=1))
            step = max(1, BLOCK_VALUES // max(1, vectors.shape[1]))
            for start in range(0, len(whole), step):
                own = whole[start : start + step]
                columns = np.ascontiguousarray(vectors[own].T)
                ids, labels = (batch.column(i).take(pa.array(own)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.array([len(own)], pa.int32()),
                        pa.array([len(columns)], pa.int32()),
                        pa.array([ids], pa.list_(pa.int64())),
                        pa.array([labels], pa.list_(pa.int64())),
                        pa.array([columns.tobytes()]),
                    ],
                    names=["block", "size", "dims", "ids", "labels", "data"],
                )
                number += 1

    whole = rows.where("label IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.col("embedding").cast("array<double>"),
    )
    # Dealt out again, as a scan costs far more than reading what it scans.
    return pin(whole.mapInArrow(parts, _BLOCK).repartition("block"))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """One row per vector, shorter ones filled up with zeros; null components are NaN."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    found = np.zeros((len(lengths), lengths.max(initial=0)))
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    found[row, place] = values
    return found


class Block:
    """Vectors of one block by dimension, with the extremes of each dimension."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.columns = np.frombuffer(row["data"]).reshape(row["dims"], row["size"])
        self.labels = np.array(row["labels"], np.int64)
        ids = row["ids"]
        self.no_id = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.largest = np.abs(self.columns).max(initial=0.0)

    def best(self, rows: np.ndarray, scores: np.ndarray, number: int) -> list[tuple]:
        """The first rows by descending score, then id: (-score, no id, id)."""
        order = np.lexsort((self.ids[rows], self.no_id[rows], -scores))[:number]
        own = rows[order]
        return list(
            zip((-scores[order]).tolist(), self.no_id[own].tolist(), self.ids[own].tolist(), strict=True)
        )


def scan(block: Block, anchor: np.ndarray, rows: np.ndarray, keep: Callable) -> tuple:
    """Rows that `keep` keeps to the end, and their inner products with the anchor.

    Dimensions are read by descending magnitude in the anchor. Those not read yet can
    add no less and no more than the extremes of the block say; `keep` is asked with
    the least and the most that each row's product may become.
    """
    columns, low, high = block.columns, block.low, block.high
    if len(anchor) * max(1.0, np.abs(anchor).max(initial=0.0)) * max(1.0, block.largest) >= EXACT:
        whole_numbers = np.vectorize(int, otypes=[object])
        anchor, columns, low, high = (whole_numbers(x) for x in (anchor, columns, low, high))
    # A dimension that one of both lacks adds nothing.
    dims = min(len(anchor), len(columns))
    order = np.argsort(-np.abs(anchor[:dims]), kind="stable")
    ends = np.stack([anchor[:dims] * low[:dims], anchor[:dims] * high[:dims]])[:, order]
    least, most = ends.min(axis=0), ends.max(axis=0)
    products = np.zeros(len(rows), anchor.dtype)
    for start in range(0, dims, STEP):
        read, rest = order[start : start + STEP], slice(start + STEP, None)
        part = columns[read] if len(rows) == columns.shape[1] else columns[np.ix_(read, rows)]
        products = products + anchor[read] @ part
        kept = keep(products + least[rest].sum(), products + most[rest].sum())
        rows, products = rows[kept], products[kept]
        if not len(rows):
            break
    return rows, products.astype(np.int64)


class Nearest:
    """The best rows of an anchor's own label, over all blocks of a task."""

    def __init__(self, number: int):
        self.number = number
        self.best: list[tuple] = []

    def _keep(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        known = np.concatenate([least, np.array([-b[0] for b in self.best], least.dtype)])
        if len(known) < self.number:
            return np.ones(len(least), bool)
        return (most >= np.sort(known)[-self.number]).astype(bool)

    def see(self, block: Block, anchor: dict) -> None:
        alike = block.labels == anchor["label"]
        if block.number == anchor["block"]:
            alike[anchor["place"]] = False
        rows, scores = scan(block, anchor["vector"], np.flatnonzero(alike), self._keep)
        self.best = sorted(self.best + block.best(rows, scores, self.number))[: self.number]

    def found(self) -> Iterator[tuple]:
        for score, no_id, i in self.best:
            yield None, None, None, -score, None if no_id else i


class Windows:
    """The best rows of other labels in the window of each positive."""

    def __init__(self, positives: list[dict], lowest: int, number: int):
        self.number = number
        self.windows = [
            # Rounded up: products are whole numbers.
            [p, -(-lowest * p["score"] // 100), p["score"], []]
            for p in positives
            if p["score"] >= 0
        ]

    def _keep(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(least), bool)
        for _, low, high, best in self.windows:
            floor = low if len(best) < self.number else max(low, -best[-1][0])
            sure = ((least >= low) & (most <= high)).astype(bool)
            if np.count_nonzero(sure) >= self.number:
                floor = max(floor, np.sort(least[sure])[-self.number])
            kept |= ((most >= floor) & (least <= high)).astype(bool)
        return kept

    def see(self, block: Block, anchor: dict) -> None:
        if not self.windows:
            return
        others = np.flatnonzero(block.labels != anchor["label"])
        rows, scores = scan(block, anchor["vector"], others, self._keep)
        for window in self.windows:
            _, low, high, best = window
            inside = (scores >= low) & (scores <= high)
            new = block.best(rows[inside], scores[inside], self.number)
            window[3] = sorted(best + new)[: self.number]

    def found(self) -> Iterator[tuple]:
        for positive, _, _, best in self.windows:
            for score, no_id, i in best:
                yield positive["place"], positive["id"], positive["score"], -score, None if no_id else i


_FOUND = "block long, place int, anchor_id long, of int, of_id long, of_score long, score long, id long"


def _scanned(blocks: Pinned, anchors: Pinned, search: Callable) -> DataFrame:
    """What `search` finds for every anchor in the blocks of each task.

    The anchors are the stated query set, asked of all rows, both in blocks. They are
    broadcast where their vectors fit the limit; else Spark reads each part of one
    side with each part of the other, and neither is shuffled or held whole.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ANCHORS):
                some = batch.slice(start, ANCHORS)
                structs = pa.StructArray.from_arrays(some.columns, names=some.schema.names)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays([0, len(structs)], structs)], names=["anchors"]
                )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, states, places = None, [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                if block is None or batch.column("block")[i].as_py() != block.number:
                    block = Block({n: batch.column(n)[i].as_py() for n in _OF_BLOCK})
                asked = batch.column("anchors")[i].values
                first = (asked.field("block")[0].as_py(), asked.field("place")[0].as_py())
                if first not in places:
                    places[first] = range(len(states), len(states) + len(asked))
                    for row in asked.to_pylist():
                        row["vector"] = np.frombuffer(row.pop("data"))
                        states.append((row, search(row)))
                for place in places[first]:
                    row, state = states[place]
                    state.see(block, row)
        for row, state in states:
            key = row["block"], row["place"], row["anchor_id"]
            found = [(*key, *x) for x in state.found()]
            if found:
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), _KINDS, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    schema = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in anchors.df.schema)
    packed = anchors.df.mapInArrow(pack, f"anchors array<struct<{schema}>>")
    size = anchors.df.agg(F.coalesce(F.sum(F.octet_length("data") + 256), F.lit(0))).first()[0]
    if size <= broadcast_limit(anchors.df.sparkSession):
        pairs = blocks.df.crossJoin(F.broadcast(packed))
    else:
        pairs = blocks.df.hint("shuffle_replicate_nl").crossJoin(packed)
    return pairs.mapInArrow(parts, _FOUND)


_NAMES = [field.split()[0] for field in _FOUND.split(", ")]
_KINDS = [pa.int32() if field.endswith(" int") else pa.int64() for field in _FOUND.split(", ")]


def _first(found: DataFrame, keys: list[str], number: int, name: str) -> DataFrame:
    """The first rows of each key, over all tasks; each task has at most `number`."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= number)


def mine(
    rows: DataFrame,
    is_anchor: Callable[[Column], Column],
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
) -> DataFrame:
    """Hard negatives of every anchor and each of its positives.

    `rows` has vec_id, label and embedding; `is_anchor` makes a condition of a vec_id
    (null: no anchor). Scores are inner products of whole components, see `pack_vectors`.
    Positives are the first `positives` other rows of the anchor's label. Negatives of a
    positive are the first `negatives` rows of other labels with a score of at least
    `lowest` per cent of the positive's and at most all of it. Higher scores come first,
    ties by smaller vec_id, null last. Returns anchor_id, positive_id, rank, negative_id,
    positive_score and negative_score.

    Two scans: one for the positives, one for all windows of an anchor at once. A block
    stands by dimension, and rows leave a scan when the dimensions still to be read
    cannot bring them among the first or into a window. Only what a task found first
    is shuffled, so a label, a vector or an anchor may have any share of the rows.

    Rows that `pack_vectors` leaves out take no part. Vectors may differ in length, as
    if filled up with zeros. Rows that repeat a vec_id are rows of their own, also as
    anchors and as positives of each other. A positive with a negative score has no
    negatives. Scores beyond a long make the query fail. Other columns are not looked
    at. An empty table gives none.
    """
    blocks = pack_vectors(rows)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                columns = np.frombuffer(row["data"]).reshape(row["dims"], row["size"])
                values = [
                    [row["block"]] * len(row["wanted"]),
                    row["wanted"],
                    [row["ids"][i] for i in row["wanted"]],
                    [row["labels"][i] for i in row["wanted"]],
                    [columns[:, i].tobytes() for i in row["wanted"]],
                ]
                arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
                names = ["block", "place", "anchor_id", "label", "data"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    placed = F.transform("ids", lambda x, i: F.struct(i.alias("place"), x.alias("id")))
    wanted = F.filter(placed, lambda row: is_anchor(row["id"]))
    asked = blocks.df.withColumn("wanted", F.transform(wanted, lambda row: row["place"]))
    anchors = pin(asked.mapInArrow(unpack, _ANCHOR))
    alike = _scanned(blocks, anchors, lambda row: Nearest(positives))
    listed = (
        _first(alike, ["block", "place"], positives, "nth")
        .groupBy("block", "place")
        .agg(F.collect_list(F.struct(F.col("nth").alias("place"), "id", "score")).alias("positives"))
    )
    asking = pin(anchors.df.join(listed, ["block", "place"]))
    hard = _scanned(blocks, asking, lambda row: Windows(row["positives"], lowest, negatives))
    return _first(hard, ["block", "place", "of"], negatives, "rank").select(
        "anchor_id",
        F.col("of_id").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("of_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def query(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = (F.col("label").cast("long") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), lambda vec_id: vec_id % 100 == 0)


SQL = """
    WITH vectors AS (
        SELECT row_number() OVER () AS row, vec_id,
               CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
          FROM embeddings
         WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
               CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
          FROM vectors a JOIN vectors b ON a.row <> b.row
         WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
          FROM scored WHERE alike QUALIFY place <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.place
                                   ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
      FROM positives p
      JOIN scored n ON n.anchor = p.anchor AND NOT n.alike
       AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
   QUALIFY rank <= 5"""
