"""Near-duplicates by SimHash, found through deletion variants of segments."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.joins import apart
from ledgerline.functions.pinning import pin
from ledgerline.llm.common import documents, whole
from ledgerline.llm.components import connected_components

BITS = 64
HASH_SEED = 42
# Shingles whose bits are counted at once, and fingerprints compared at once.
CHUNK = 1 << 15
# In larger buckets a forest of links is built instead of every link.
SMALL_BUCKET = 6


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the word shingles of UTF-8 text, as an unsigned number.

    A bit is set when it is in over half the shingle hashes. Fewer words than a
    shingle has are one shingle; no word gives 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(words) - shingle + 1)].tolist()
    ends = ends[shingle - 1 :].tolist() or [len(joined)]
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, text_hash and fingerprint (a signed long) of every row."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column("text").cast(pa.binary())
            found = np.fromiter(
                (fingerprint(text.as_py(), shingle) for text in texts), "<u8", len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], pa.array(found.view("<i8"))],
                names=["doc_id", "text_hash", "fingerprint"],
            )

    text = whole(F.col("text")).alias("text")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, text_hash long, fingerprint long")


def segments(max_bits: int) -> list[int]:
    """Masks of the fewest segments of which one differs by at most one bit."""
    number = max_bits // 2 + 1
    cuts = [BITS * i // number for i in range(number + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints that differ by at most `max_bits`.

    `prints` has the distinct values in column `fingerprint`. Links of small
    buckets are all there; of larger ones, as many as connect what is linked, so
    that no group is expanded into all its pairs.
    """
    masks = segments(max_bits)
    variants = [
        _signed(mask & ~(1 << bit)) for bit in range(BITS) for mask in masks if mask >> bit & 1
    ]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bits, prints in _buckets(parts):
            a, b = _bucket_links(bits, prints, np.array(masks, np.uint64), max_bits)
            for at in range(0, len(a), CHUNK):
                pair = [pa.array(x[at : at + CHUNK].view("<i8")) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(pair, names=["a", "b"])

    exploded = prints.select(
        "fingerprint", F.posexplode(F.array(*map(F.lit, variants))).alias("bit", "mask")
    ).select("bit", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("rest"), "fingerprint")
    together = exploded.repartition("bit", "rest").sortWithinPartitions("bit", "rest")
    return together.mapInArrow(batches, "a long, b long").distinct()


def _buckets(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole buckets of sorted rows, many at a time: a bucket number and the prints.

    A bucket's fingerprints are distinct and take 8 bytes each.
    """
    kept: list[np.ndarray] = []
    for part in parts:
        bit, rest, prints = (np.asarray(c).astype("<i8") for c in part.columns)
        kept.append(np.stack([bit, rest, prints]))
        same = (kept[-1][:2] == kept[-1][:2, -1:]).all(axis=0)
        first = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if first:
            yield _numbered(np.concatenate([*kept[:-1], kept[-1][:, :first]], axis=1))
            kept = [kept[-1][:, first:]]
    if kept:
        yield _numbered(np.concatenate(kept, axis=1))


def _numbered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
    number = np.concatenate([[0], np.cumsum(new)])
    # The wildcard bit travels with the number of the bucket.
    return np.stack([number, rows[0]]), rows[2].view("<u8")


def _bucket_links(bits, prints, masks, max_bits) -> tuple[np.ndarray, np.ndarray]:
    number, wildcard = bits
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    sizes = np.diff(np.append(starts, len(number)))
    size_of = np.repeat(sizes, sizes)
    found = [(prints[:0], prints[:0])]
    small = (size_of > 1) & (size_of <= SMALL_BUCKET)
    for step in range(1, SMALL_BUCKET):
        at = np.flatnonzero(small[:-step] & (number[:-step] == number[step:])) if step < len(number) else []
        a, b = prints[at], prints[np.asarray(at, np.int64) + step]
        near = np.bitwise_count(a ^ b) <= max_bits
        a, b, bit = a[near], b[near], wildcard[at][near]
        own = _first_variant(a ^ b, masks) == bit
        found.append((a[own], b[own]))
    for start, size in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET], strict=True):
        found.append(_forest(prints[start : start + size], max_bits))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return a, b


def _first_variant(differ: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """The first wildcard bit whose bucket two fingerprints share."""
    bit = np.full(len(differ), -1)
    for mask in masks[::-1]:
        part = differ & mask
        few = np.bitwise_count(part) <= 1
        lone = np.where(part == 0, mask & (~mask + np.uint64(1)), part)
        bit = np.where(few, np.bitwise_count(lone - np.uint64(1)), bit)
    return bit


def _forest(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all that is linked in one bucket, one less than nodes.

    Grows one group after the other: what the front is near to joins the group and
    is not looked at again, so copies of one text cost little however many.
    """
    a, b = [], []
    rest = prints
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            new = []
            for node in front:
                near = np.bitwise_count(rest ^ node) <= max_bits
                if near.any():
                    new.append(rest[near])
                    a.append(np.full(len(new[-1]), node))
                    rest = rest[~near]
            front = np.concatenate(new) if new else prints[:0]
            b.extend(new)
    none = [prints[:0]]
    return np.concatenate(a or none), np.concatenate(b or none)


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """Groups of documents whose fingerprints are linked, directly or over others.

    Returns doc_id, text_hash, fingerprint (16 hex digits), component_id (the
    smallest doc_id of the group) and `keep`, true for the one row to keep of each
    group: the smallest doc_id, and of rows with that doc_id the smallest text_hash;
    only equal (doc_id, text) rows are both true.

    Fingerprints that differ by `max_bits` or fewer bits are linked. They are cut
    into the fewest segments of which one then differs by at most one bit. Each
    segment is indexed once per bit with that bit left out; an equality join on
    these variants finds every linked pair, and the whole fingerprints verify it.

    A null text is empty; texts without words have fingerprint 0 and are linked
    like others. A group without any doc_id has a null component_id. Other columns
    are not looked at. No row is lost, an empty table gives none.
    """
    rows = pin(fingerprints(docs, shingle)).df
    lowest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("lowest")
    classes = pin(rows.groupBy("fingerprint").agg(lowest)).df
    groups = connected_components(links(classes.select("fingerprint"), max_bits))
    rooted = classes.join(groups, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "lowest"
    )
    of_root = rooted.groupBy(*apart("root")).agg(F.min("lowest").alias("first"))
    named = rooted.join(of_root.select("root", "first"), "root").select(
        F.col("fingerprint").alias("of_print"), "first"
    )
    joined = rows.join(named, F.col("fingerprint") == F.col("of_print"))
    return joined.select(
        "doc_id",
        "text_hash",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        (
            F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
            & (F.col("text_hash") == F.col("first.text_hash"))
        ).alias("keep"),
    )


def query(spark, sf_dir) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "fingerprint", "component_id"
    )
