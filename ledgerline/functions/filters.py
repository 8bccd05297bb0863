"""Filters on the keys of another table that work before any shuffle."""

from collections.abc import Callable
from decimal import Decimal
from functools import reduce
from itertools import pairwise
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerline.functions.pinning import Pinned, broadcast_limit, fits_broadcast

# Literal ranges in a filter, steps in which gaps between keys are looked for, and how
# often the steps are made finer.
_MOST_RANGES, _STEPS, _ROUNDS = 32, 4096, 3
# A block of a Bloom filter is _WORDS words of 64 bits. A key sets a bit in each of them,
# so that with _KEYS keys in a block fewer than one in a hundred others passes.
_WORDS, _KEYS = 8, 32
# Bytes of a block in a broadcast table, with its number; tables at most, and what one
# may take where the session broadcasts less or nothing.
_BLOCK_BYTES, _MOST_TABLES, _TABLE_BYTES = 100, 16, 8 << 20

RAW = "__raw_"


def of_keys(rows: DataFrame, keys: Pinned, key: str) -> DataFrame:
    """`rows` without most of those whose `key` is not in `keys`; none that is.

    `keys` was pinned with the bounds of its column `key`. First come literal ranges of
    the keys, which reach the statistics of Parquet files. Within them keys are looked
    up: in a broadcast of the key column where that fits, else in Bloom filters, each a
    table of at most 8 MB or the broadcast limit. Where one cannot hold all keys, each
    holds a range of them and meets only the rows of that range, in a scan of its own.
    Where more than 16 would be needed, only the literal ranges filter. The caller's join
    or group decides, so none of this makes a difference to a result.
    """
    ranges = key_ranges(keys, key)
    wanted = keys.df.select(key)
    if fits_broadcast(wanted, keys.rows):
        return in_ranges(rows, key, ranges).join(F.broadcast(wanted), key, "left_semi")
    parts = _parts(keys, key, ranges)
    if len(parts) > _MOST_TABLES:
        return in_ranges(rows, key, ranges)
    filtered = (
        _bloom(in_ranges(rows, key, part), in_ranges(wanted, key, part), [key], blocks(keys.rows // len(parts)))
        for part in parts
    )
    return reduce(DataFrame.unionAll, filtered)


def within(rows: DataFrame, keys: Pinned, key: str) -> DataFrame:
    """`rows` whose `key` is in one of the ranges that the keys of `keys` fall into."""
    return in_ranges(rows, key, key_ranges(keys, key))


def equal_to(rows: DataFrame, key: str, value: int) -> DataFrame:
    """`rows` whose `key` is `value`."""
    return in_ranges(rows, key, [(value, value)])


def like(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` without most of those whose `keys` no row of `others` has; none that has.

    One Bloom filter of bounded size, however many rows `others` has. The more they are,
    the more others pass; it pays where they are few.
    """
    return _bloom(rows, others, keys, _table_bytes(rows) // _BLOCK_BYTES)


def in_ranges(rows: DataFrame, key: str, ranges: list[tuple]) -> DataFrame:
    """`rows` whose `key` is in one of `ranges`, by literals.

    Where `key` was converted from another type, the column it was made from is compared
    too, in its own type: that reaches the files, which a conversion does not.
    """
    if not ranges:
        return rows.where(F.lit(False))
    rows = rows.where(_any(F.col(key), ranges, _literal))
    if RAW + key in rows.columns:
        kind = rows.schema[RAW + key].dataType
        rows = rows.where(_any(F.col(RAW + key), *_as_type(ranges, kind)))
    return rows


def _literal(value: int) -> Column:
    return F.lit(value if -(2**63) <= value < 2**63 else Decimal(value))


def _any(column: Column, ranges: list[tuple], literal: Callable) -> Column:
    def inside(low, high) -> Column:
        return column == literal(low) if low == high else column.between(literal(low), literal(high))

    return reduce(or_, (inside(*ends) for ends in ranges), F.lit(False))


def _as_type(ranges: list[tuple], kind) -> tuple[list[tuple], Callable]:
    """The ranges as far as values of the type `kind` reach, and their literals."""
    if not isinstance(kind, DecimalType):
        return ranges, _literal
    most = 10 ** (kind.precision - kind.scale) - 1
    reached = [(max(low, -most), min(high, most)) for low, high in ranges if low <= most and high >= -most]
    return reached, lambda value: F.lit(Decimal(value)).cast(kind)


def key_ranges(keys: Pinned, key: str) -> list[tuple]:
    """At most 32 ranges that hold all keys, cut at the largest gaps between them.

    The range of all keys is taken in 4,096 steps, of which those with keys give their
    least and largest. Cut at gaps of a thirty-second and more, it covers less, in which
    steps can be finer: a few stray keys far away from each other and from the others
    cost a round each. A round groups the stored keys, and at most some 4,100 rows come
    back. Where the keys themselves are no more, they come back instead.
    """
    if key not in keys.ranges:
        keys.ranges[key] = _key_ranges(keys, key)
    return keys.ranges[key]


def _key_ranges(keys: Pinned, key: str) -> list[tuple]:
    if keys.low is None:
        return []
    ranges, values = [(int(keys.low), int(keys.high))], None
    if keys.rows <= _STEPS and keys.low != keys.high:
        found = keys.df.where(F.col(key).isNotNull()).select(key).collect()
        values = [(v, v) for v in sorted({int(r[0]) for r in found})]
    for _ in range(_ROUNDS):
        covered = _covered(ranges)
        if covered <= 4 * keys.rows:
            break
        ranges = _cut(values or _occupied(keys.df, key, covered // _STEPS + 1), covered)
        if 2 * _covered(ranges) > covered:
            break
    return ranges


def _covered(ranges: list[tuple]) -> int:
    return sum(high - low + 1 for low, high in ranges)


def _occupied(keys: DataFrame, key: str, step: int) -> list[tuple]:
    value = F.col(key)
    start = value - value % _literal(step).cast(keys.schema[key].dataType)
    found = (
        keys.where(value.isNotNull())
        .groupBy(start.alias("start"))
        .agg(F.min(key).alias("low"), F.max(key).alias("high"))
        .select("low", "high")
    )
    return sorted((int(r["low"]), int(r["high"])) for r in found.collect())


def _cut(ranges: list[tuple], covered: int) -> list[tuple]:
    """Neighbouring ranges joined over all but the gaps that matter."""
    gaps = sorted(((b[0] - a[1], i) for i, (a, b) in enumerate(pairwise(ranges))), reverse=True)
    cuts = sorted(i + 1 for gap, i in gaps[: _MOST_RANGES - 1] if gap * _MOST_RANGES >= covered)
    ends = [0, *cuts, len(ranges)]
    return [(ranges[a][0], ranges[b - 1][1]) for a, b in pairwise(ends)]


def blocks(rows: int) -> int:
    """Blocks of a Bloom filter for so many keys."""
    return rows // _KEYS + 1


def _table_bytes(df: DataFrame) -> int:
    return max(broadcast_limit(df.sparkSession), _TABLE_BYTES)


def _parts(keys: Pinned, key: str, ranges: list[tuple]) -> list[list[tuple]]:
    """The ranges, dealt to parts whose Bloom filters fit the broadcast limit."""
    number = -(-blocks(keys.rows) * _BLOCK_BYTES // _table_bytes(keys.df))
    if number == 1 or number > _MOST_TABLES:
        return [ranges] * number
    # Quantiles are approximate, and equal keys stay together: some room for that.
    number = min(number + number // 8 + 1, _MOST_TABLES)
    shares = [i / number for i in range(1, number)]
    cuts = keys.df.agg(F.percentile_approx(key, shares, 10_000)).first()[0]
    ends = [int(keys.low) - 1, *sorted({int(c) for c in cuts}), int(keys.high)]
    parts = [
        [(max(low, a + 1), min(high, b)) for low, high in ranges if low <= b and high > a]
        for a, b in pairwise(ends)
    ]
    return [part for part in parts if part]


def _bloom(rows: DataFrame, others: DataFrame, keys: list[str], number: int) -> DataFrame:
    """`rows` whose `keys` a Bloom filter of `number` blocks over `others` may hold.

    The filter is a table of a row per block. A row finds its block in the broadcast,
    and its bits in the block's words.
    """
    word = [f"__word{i}" for i in range(_WORDS)]

    def block() -> Column:
        return F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(number))

    def bit(i: int) -> Column:
        # Six bits of the second hash for each word.
        place = F.pmod(F.shiftrightunsigned(F.xxhash64(F.lit(2), *keys), 6 * i), F.lit(64)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    there = reduce(and_, (F.col(k).isNotNull() for k in keys))
    table = (
        others.where(there)
        .groupBy(block().alias("__block"))
        .agg(*(F.bit_or(bit(i)).alias(w) for i, w in enumerate(word)))
    )
    found = rows.withColumn("__block", block()).join(F.broadcast(table), "__block")
    marked = reduce(and_, (F.col(w).bitwiseAND(bit(i)) != 0 for i, w in enumerate(word)))
    return found.where(marked & there).select(rows.columns)

