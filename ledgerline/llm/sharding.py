"""Shards that each hold the same mixture of sources."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm.common import documents, replace_columns, running_total, whole

# Steps into which fractional ranks are cut, so that no task orders all rows.
STEPS = 8192


def shuffle_key(seed: int) -> Column:
    """A seeded order of documents that depends on the doc_id alone."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def shuffle_bucket(seed: int, tie: Column) -> Column:
    """Coarser steps of the order by `key` and a tie, of which `tie` is a step under 10,000.

    Rows without doc_id have one key. They lie in steps of their own, by `tie`.
    """
    key, none, start = F.col("key"), F.md5(F.lit(f"{seed}:")), F.substring("key", 1, 3)
    steps = F.concat(start, F.lit("1"), F.lpad(tie.cast("string"), 4, "0"))
    return F.when(key < none, F.concat(start, F.lit("0"))).otherwise(
        F.when(key > none, F.concat(start, F.lit("2"))).otherwise(steps)
    )


def unit(text: Column) -> Column:
    """A number from 0 to under 1 that depends on the text alone."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 2.0**32


def interleave(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """All columns of `docs`, with `shard` and `slot`.

    Within each source the rows are shuffled by seed and ranked; the fractional
    rank is (rank - u) / (rows of the source), u being a number from 0 to 1 of the
    source's own. All rows are ordered by it and cut into shards whose row counts
    differ by one at most, so every stretch has the mixture of the whole. Slots
    number a shard's rows from 0 in that order.

    Needs doc_id, source and text. Null sources are a source of their own. A null
    or repeated doc_id is allowed: ties are ordered by text. Rows without doc_id are
    dealt to buckets by their text; rows that repeat a doc_id lie in one bucket. Columns
    of `docs` called shard or slot give way. No row is lost, an empty table gives none.

    Nothing is ordered as a whole: ranks come from windows over buckets of the
    shuffle key within a source, and over steps of the fractional rank, with
    offsets from tables of bounded size.
    """
    packed = docs.select(
        F.struct("*").alias("row"),
        F.col("source").isNull().alias("no_source"),
        whole(F.col("source")).alias("stratum"),
        shuffle_key(seed).alias("key"),
        F.crc32(whole(F.col("text")).cast("binary")).alias("tie"),
    ).withColumn("bucket", shuffle_bucket(seed, F.shiftright("tie", 20)))
    strata = ["no_source", "stratum"]
    sizes = pin(packed.groupBy(*strata).agg(F.count(F.lit(1)).alias("of")))
    total = sizes.df.agg(F.coalesce(F.sum("of"), F.lit(0))).first()[0]
    ranked = running_total(packed, strata, "bucket", ["key", "tie"], F.lit(1))
    fraction = (F.col("before") + 1 - unit(F.col("stratum"))) / F.col("of")
    placed = (
        ranked.join(sizes.side, strata)
        .withColumn("fraction", fraction)
        .withColumn("step", F.floor(F.col("fraction") * STEPS))
        .withColumn("one", F.lit(1))
        .drop("before", "bucket")
    )
    order = ["fraction", *strata, "key", "tie"]
    numbered = running_total(placed, ["one"], "step", order, F.lit(1))
    shard = F.expr(f"before * {shards} div {total}")
    # The first row of shard k is the smallest row number with that quotient.
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    cut = numbered.withColumn("shard", shard.cast("int")).withColumn(
        "slot", F.col("before") - first
    )
    return replace_columns(cut, docs, "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; its files, and the rows in them, are in slot order.

    Ranges of slots share out a shard over tasks, however large it is.
    """
    (
        sharded.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def query(spark, sf_dir) -> DataFrame:
    text = whole(F.col("text"))
    light = documents(spark, sf_dir).select(
        "doc_id",
        "source",
        # What orders ties is the checksum of the text, taken here once.
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
    )
    rows = pin(light).df.withColumn("text", F.col("text_crc32").cast("string"))
    return interleave(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
