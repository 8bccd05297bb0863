"""Conversations that begin alike, as a trie, and sums over its subtrees."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.pinning import Pinned, pin
from ledgerline.llm.common import WORD, whole

# Turns of one conversation that are ordered in one task.
BUCKET = 4096
# Of the contract: conversations in a block share the beginning of its first.
BLOCK, MOST_SHARED = 20, 4

KEY = ["key1", "key2"]


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """id and, for each column of `values`, its sum over the node's whole subtree.

    `nodes` has id, parent (null or unknown: a root) and long columns `values`
    without nulls; ids are unique and not null. Raises ValueError when it is no forest.

    Tree contraction in rounds of joins. Rake takes all leaves away and adds their sums
    to their parents. Compress takes nodes with one child away whose parent has one
    child too, a random half of those whose parent stays, and hangs the child below the
    parent, which takes over the node's sum. So a chain of any length needs a number of
    rounds that grows with its logarithm. The rounds are then undone from the last: a
    compressed node's sum is what it had then plus its child's.

    Children are grouped by parent with partial sums, all joins are on unique ids: a
    node may have any number of children. Every round is stored.
    """
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
    counts = children.agg(F.count(F.lit(1)).alias("n"))
    counted = nodes.select("id", "parent", *values).join(counts, "id", "left")
    live = pin(counted.withColumn("n", F.coalesce("n", F.lit(0))))
    leaves, compressed = [], []
    while live.rows:
        raked = live.df.where("n = 0").select("id", "parent", *values)
        leaves.append(raked.drop("parent"))
        inner = pin(_without_leaves(live.df, raked, values))
        if inner.rows == live.rows:
            raise ValueError("some nodes are their own ancestors")
        live, found = inner, None
        if inner.rows:
            found = pin(_removable(inner.df, values, len(leaves)))
            if found.rows:
                live = pin(_without_removed(inner.df, found.df, values))
        compressed.append(found)
    if not leaves:
        return live.df.select("id", *values)
    return _expanded(leaves, compressed, values)


def _without_leaves(live: DataFrame, raked: DataFrame, values: list[str]) -> DataFrame:
    given = raked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("gone"), *(F.sum(v).alias(f"more_{v}") for v in values)
    )
    joined = live.where("n > 0").join(given, "id", "left")
    return joined.select(
        "id", "parent", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"), *_added(values)
    )


def _removable(inner: DataFrame, values: list[str], turn: int) -> DataFrame:
    """Nodes to compress: id, their only child, the parent that takes over, values."""
    children = inner.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id"))
    only = children.agg(F.min("id").alias("child"))
    unary = inner.where("n = 1").join(only, "id")

    def goes(node: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(turn), node), F.lit(2)) == 1

    above = unary.where(~goes("id")).select(F.col("id").alias("heir"), F.col("child").alias("id"))
    return unary.where(goes("id")).join(above, "id").select("id", "child", "heir", *values)


def _without_removed(inner: DataFrame, found: DataFrame, values: list[str]) -> DataFrame:
    def change(node: str, goes: bool, above: Column, more: list[Column]) -> DataFrame:
        return found.select(
            F.col(node).alias("id"),
            F.lit(goes).alias("goes"),
            above.alias("above"),
            *(x.alias(f"more_{v}") for v, x in zip(values, more, strict=True)),
        )

    none, zeros = F.lit(None).cast(found.schema["id"].dataType), [F.lit(0).cast("long")] * len(values)
    changes = (
        change("id", True, none, zeros)
        .union(change("child", False, F.col("heir"), zeros))
        .union(change("heir", False, none, [F.col(v) for v in values]))
        # The child of one may be the heir of another.
        .groupBy("id")
        .agg(
            F.max("goes").alias("goes"),
            F.max("above").alias("above"),
            *(F.sum(f"more_{v}").alias(f"more_{v}") for v in values),
        )
    )
    kept = inner.join(changes, "id", "left").where(~F.coalesce("goes", F.lit(False)))
    return kept.select("id", F.coalesce("above", "parent").alias("parent"), "n", *_added(values))


def _added(values: list[str]) -> list[Column]:
    return [(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values]


def _expanded(leaves: list[DataFrame], compressed: list[Pinned | None], values: list[str]) -> DataFrame:
    # A child ended in a later round than its parent was compressed in, so what is
    # looked up shrinks with the rounds as the tree did.
    known = None
    for ended, found in zip(reversed(leaves), reversed(compressed), strict=True):
        if known is not None and found is not None and found.rows:
            below = known.select(F.col("id").alias("child"), *(F.col(v).alias(f"more_{v}") for v in values))
            known = known.union(pin(found.df.join(below, "child").select("id", *_added(values))).df)
        known = ended if known is None else known.union(ended)
    return known


def _ordered(turns: DataFrame) -> Pinned:
    """Turns of conversations by place, from 0: hashes of role and text, number of words.

    Turns are sorted in ranges of (conversation, turn, role, text), so one conversation
    may span many tasks; numbers of rows and one row per range and conversation give
    the places.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text")
    )
    numbered = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.monotonically_increasing_id().alias("number"),
            F.xxhash64("role", "text").alias("hash1"),
            F.xxhash64(F.lit("second"), "role", "text").alias("hash2"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        )
    )
    # The upper bits are the number of the range.
    stored = pin(numbered.withColumn("range", F.shiftright("number", 33))).df
    parts = stored.groupBy("conv_id", "range").agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("size")
    )
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    shifts = parts.select("conv_id", "range", (before - F.col("first")).alias("shift"))
    placed = stored.join(shifts, ["conv_id", "range"])
    place = F.col("number") + F.col("shift")
    return pin(placed.select("conv_id", place.alias("place"), "hash1", "hash2", "words"))


def shared_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its block."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, depth, hashes, words).

    Every conversation has the first turns of its block's first conversation, as many
    as `shared_length` says, then its own turns after as many.
    """
    placed = _ordered(turns).df
    sizes = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    turn = F.struct("place", "hash1", "hash2", "words")
    heads = (
        placed.where((F.col("conv_id") % BLOCK == 0) & (F.col("place") < MOST_SHARED - 1))
        .groupBy(F.col("conv_id").alias("block"))
        # At most three.
        .agg(F.array_sort(F.collect_list(turn)).alias("head"))
    )
    none = F.array().cast("array<struct<place:bigint,hash1:bigint,hash2:bigint,words:bigint>>")
    block = F.col("conv_id") - F.col("conv_id") % BLOCK
    shared = shared_length(F.col("conv_id")).cast("int")
    convs = sizes.withColumn("block", block).join(heads, "block", "left").select(
        "conv_id",
        "size",
        shared.alias("shared"),
        F.slice(F.coalesce("head", none), F.lit(1), shared).alias("head"),
    )
    taken = F.size("head")
    length = taken + F.greatest(F.col("size") - F.col("shared"), F.lit(0))
    convs = pin(convs.withColumn("length", length)).df
    # A row per bucket of places, so that no key holds more than a bucket.
    buckets = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("size") / BUCKET)))
    rule = convs.select("conv_id", "shared", taken.alias("taken"), buckets.alias("bucket"))
    own = (
        placed.withColumn("bucket", F.floor(F.col("place") / BUCKET))
        .join(rule, ["conv_id", "bucket"])
        .where("place >= shared")
        .withColumn("depth", F.col("place") - F.col("shared") + F.col("taken") + 1)
    )
    columns = ["conv_id", "depth", "hash1", "hash2", "words"]
    begun = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.place") + 1).alias("depth"), "t.hash1", "t.hash2", "t.words"
    )
    return convs.select("conv_id", "length"), own.select(columns).union(begun.select(columns))


def _paths(turns: DataFrame) -> DataFrame:
    """Add the key of the node that each turn ends at, and of its parent.

    A key is the exclusive or of hashes of (depth, turn) over all turns so far, of two
    64-bit hashes. Running values are taken per bucket of depths, and what the buckets
    before add up to comes from one row per bucket.
    """
    steps = turns.select(
        "conv_id",
        "depth",
        "words",
        F.floor(F.col("depth") / BUCKET).alias("bucket"),
        F.xxhash64("depth", "hash1", "hash2").alias("step1"),
        F.xxhash64(F.lit("second"), "depth", "hash1", "hash2").alias("step2"),
    )
    totals = steps.groupBy("conv_id", "bucket").agg(*(F.bit_xor(f"step{i}").alias(f"all{i}") for i in (1, 2)))
    first = Window.unboundedPreceding
    earlier = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(first, -1)
    offsets = totals.select(
        "conv_id",
        "bucket",
        *(F.coalesce(F.bit_xor(f"all{i}").over(earlier), F.lit(0)).alias(f"offset{i}") for i in (1, 2)),
    )
    inside = Window.partitionBy("conv_id", "bucket").orderBy("depth").rowsBetween(first, 0)
    running = steps.withColumns({f"run{i}": F.bit_xor(f"step{i}").over(inside) for i in (1, 2)})
    keyed = running.join(offsets, ["conv_id", "bucket"])
    for i in (1, 2):
        keyed = keyed.withColumn(f"key{i}", F.col(f"run{i}").bitwiseXOR(F.col(f"offset{i}")))
        keyed = keyed.withColumn(f"parent{i}", F.col(f"key{i}").bitwiseXOR(F.col(f"step{i}")))
    return keyed.select("conv_id", "depth", "words", *KEY, "parent1", "parent2")


def digests(members: DataFrame, keys: list[str]) -> DataFrame:
    """SHA-256, as hex, of the ids of each key in ascending order, joined by commas.

    `members` has two long columns `keys` and conv_id, unique and not null. Ids are
    sorted in ranges of (key, id) and joined to pieces there, so a key may have any
    number of them. Only the pieces of a key meet in one task, which a hash of one
    string makes necessary; they pass through it and are never held together.
    """
    names = [*keys, "first", "piece"]
    types = " long, ".join(keys) + " long, first long, piece string"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two, ids = (batch.column(i).to_numpy() for i in range(3))
            new = np.flatnonzero((np.diff(one, prepend=one[0]) != 0) | (np.diff(two, prepend=two[0]) != 0))
            starts = np.concatenate([[0], new])
            texts = [",".join(map(str, part.tolist())) for part in np.split(ids, new)]
            arrays = [pa.array(x) for x in (one[starts], two[starts], ids[starts], texts)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for *own, _, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
            yield _digests(done, keys)
        if key is not None:
            yield _digests([(*key, digest.hexdigest())], keys)

    order = [*keys, "conv_id"]
    sorted_ids = members.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = sorted_ids.mapInArrow(pieces, types)
    dealt = joined.repartition(*keys).sortWithinPartitions(*keys, "first")
    return dealt.mapInArrow(hashed, " long, ".join(keys) + " long, digest string")


def _digests(done: list[tuple], keys: list[str]) -> pa.RecordBatch:
    one, two, digest = zip(*done, strict=True) if done else ((), (), ())
    arrays = [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(digest, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=[*keys, "digest"])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    `turns` has conv_id, turn, role and text. Turns are ordered by turn, null first,
    then by role and text; a null role or text is empty. See `rebuilt` for what
    conversations are made of. A node is a distinct sequence of the first `depth` turns,
    its members the conversations that begin with it. Returns conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 (of the members that have no more turns).

    Rows with a null conv_id belong to no conversation and are not looked at; rows that
    are equal are turns of their own. A conversation whose rebuilt form has no turn is a
    member of the root alone. Other columns are not looked at. An empty table gives no
    node, not even a root. Sequences are told apart by 128 bits of hash.
    """
    convs, rows = rebuilt(turns)
    paths = pin(_paths(rows)).df
    members = F.count(F.lit(1)).alias("n_convs")
    least = F.min("conv_id").alias("conv_id")
    inner = paths.groupBy(*KEY, "depth").agg(
        members,
        least,
        *(F.first(c).alias(c) for c in ("words", "parent1", "parent2")),
    )
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(members, least).where("n_convs > 0").select(
        zero.alias("key1"),
        zero.alias("key2"),
        zero.alias("depth"),
        "n_convs",
        "conv_id",
        zero.alias("words"),
        null.alias("parent1"),
        null.alias("parent2"),
    )
    nodes = pin(inner.select(root.columns).union(root)).df
    families = nodes.where("parent1 IS NOT NULL").groupBy(
        F.col("parent1").alias("key1"), F.col("parent2").alias("key2")
    )
    counts = families.agg(F.count(F.lit(1)).alias("n_children"))
    known = pin(
        nodes.join(counts, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    ).df
    named = _named(known.withColumn("leaves", (F.col("n_children") == 0).cast("long")))
    saved = (F.col("n_convs") - 1) * F.col("words")
    sums = subtree_sums(named.withColumn("saved", saved), ["leaves", "saved"])
    sums = sums.select(
        F.conv(F.substring("id", 1, 16), 16, -10).cast("long").alias("key1"),
        F.conv(F.substring("id", 17, 16), 16, -10).cast("long").alias("key2"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
    )
    last = paths.join(convs.withColumnRenamed("length", "depth"), ["conv_id", "depth"], "left_semi")
    turnless = convs.where("length = 0").select("conv_id", zero.alias("key1"), zero.alias("key2"))
    ends = digests(last.select("conv_id", *KEY).union(turnless), KEY)
    above = nodes.select(
        F.col("key1").alias("parent1"), F.col("key2").alias("parent2"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        known.join(sums, KEY)
        .join(ends, KEY, "left")
        .join(above, ["parent1", "parent2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _named(nodes: DataFrame) -> DataFrame:
    """Keys of nodes and their parents as one string each: id and parent."""

    def name(one: str, two: str) -> Column:
        return F.concat(*(F.lpad(F.hex(F.col(x)), 16, "0") for x in (one, two)))

    return nodes.withColumns({"id": name("key1", "key2"), "parent": name("parent1", "parent2")})


def query(spark, sf_dir) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# The remainder of crc32 bit by bit: DuckDB has no function for it.
SQL = """
    WITH ids AS (
        SELECT conv_id, conv_id - conv_id % 20 AS block,
               xor(list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(
                           string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
                       lambda crc, byte: list_reduce(
                           list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda v, bit: xor(v >> 1, (v & 1) * 3988292384))),
                   4294967295::BIGINT) % 4 AS shared
          FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
    placed AS (
        SELECT conv_id, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS step,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words,
               row_number() OVER (PARTITION BY conv_id
                   ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
          FROM conversations WHERE conv_id IS NOT NULL),
    begun AS (
        SELECT i.conv_id, p.place + 1 AS depth, p.step, p.words
          FROM ids i JOIN placed p ON p.conv_id = i.block AND p.place < i.shared),
    taken AS (SELECT conv_id, count(*) AS taken FROM begun GROUP BY conv_id),
    turns AS (
        SELECT i.conv_id, 0 AS depth, '' AS step, 0 AS words FROM ids i
        UNION ALL SELECT * FROM begun
        UNION ALL
        SELECT i.conv_id, p.place - i.shared + coalesce(t.taken, 0) + 1, p.step, p.words
          FROM ids i JOIN placed p ON p.conv_id = i.conv_id AND p.place >= i.shared
          LEFT JOIN taken t ON t.conv_id = i.conv_id),
    paths AS (
        SELECT *, string_agg(step, '') OVER sofar AS key,
               depth = max(depth) OVER (PARTITION BY conv_id) AS ends
          FROM turns WINDOW sofar AS (PARTITION BY conv_id ORDER BY depth)),
    nodes AS (
        SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')
                   AS ended
          FROM paths GROUP BY key, depth),
    families AS (
        SELECT p.key, count(*) AS n_children
          FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 GROUP BY p.key),
    sums AS (
        SELECT p.key, count(*) FILTER (WHERE f.key IS NULL) AS n_leaves,
               sum((n.n_convs - 1) * n.words) AS saved_tokens
          FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
          LEFT JOIN families f ON f.key = n.key
         GROUP BY p.key)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs,
           coalesce(f.n_children, 0) AS n_children, s.n_leaves,
           CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ended) AS ends_sha256
      FROM nodes n JOIN sums s ON s.key = n.key LEFT JOIN families f ON f.key = n.key
      LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
      LEFT JOIN nodes a ON a.key = p.key"""
