"""Sources mixed to target weights, within a number of epochs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pinning import pin
from ledgerline.llm.common import WORD, documents, replace_columns, running_total, whole
from ledgerline.llm.sharding import shuffle_bucket, shuffle_key

# Of the contract: weights by the order of sources, the share of all words that
# the mix is to have, and the times a source may be used.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2.0

SOURCE = ["no_source", "source_name"]


def word_count(text) -> F.Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add `weight`: the weights in turn, by code point order of sources, null last."""
    # Ranges of sources are numbered apart: no task orders all of them.
    ranges = pin(
        sources.repartitionByRange(*SOURCE).select("*", F.spark_partition_id().alias("range"), F.lit(1).alias("one"))
    )
    placed = running_total(ranges.df, ["one"], "range", SOURCE, F.lit(1))
    place = F.pmod(F.col("before"), F.lit(len(weights))) + 1
    which = F.element_at(F.array(*map(F.lit, weights)), place.cast("int"))
    return placed.withColumn("weight", which.cast("double")).drop("one", "range", "before")


def water_fill(sources: DataFrame, total: float) -> DataFrame:
    """Add `target`: `total` dealt out by `weight`, none above its `cap`.

    The excess of clamped sources goes to the others by weight, which may clamp
    more of them, until none is above its cap. With too little room overall every
    source gets its cap; so does one with a null, zero or negative weight only if
    its cap is zero, else it gets nothing.

    Each round is one aggregate over the table of sources, of which two numbers
    come to the driver.
    """
    weight = F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))
    level, clamped = 0.0, -1
    while True:
        over = weight * F.lit(level) >= F.col("cap")
        at_cap = over & (weight > 0)
        found = sources.agg(
            F.coalesce(F.sum(F.when(at_cap, F.col("cap"))), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~at_cap, weight)), F.lit(0.0)).alias("free"),
            F.count(F.when(at_cap, 1)).alias("clamped"),
        ).first()
        if found["free"] == 0:
            level = None
            break
        if found["clamped"] == clamped:
            break
        level, clamped = (total - found["used"]) / found["free"], found["clamped"]
    share = F.col("cap") if level is None else F.least(weight * F.lit(level), F.col("cap"))
    return sources.withColumn("target", F.when(weight > 0, share).otherwise(F.lit(0.0)))


def mix(
    docs: DataFrame,
    size: str,
    weights=cyclic_weights,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = 11,
) -> DataFrame:
    """All columns of `docs`, with `source_size`, `target` and `copies`.

    The mix is to have `share` times the sum of column `size` (not null, not
    negative), dealt out to sources by water filling over the weights that the
    function `weights` adds to the table of sources, at most `epochs` times a
    source's size. `copies` is how often the mix takes a row: the whole number of
    repetitions of its source, and one more for the first rows, in a seeded order,
    that make up the rest. A row counts as inside the rest when at least half its
    size is, so a source's words differ from its target by half a row at most.

    Needs doc_id and source. Null is a source of its own. Rows with equal doc_id
    are ordered by size and then alike; those without one are dealt to buckets by size
    too. A source without words gets target 0 and
    no copy. Columns of `docs` with the names of new ones give way. Every row
    comes back, an empty table gives none.
    """
    packed = docs.select(
        F.struct("*").alias("row"),
        F.col("source").isNull().alias("no_source"),
        whole(F.col("source")).alias("source_name"),
        F.col(size).alias("words"),
        shuffle_key(seed).alias("key"),
    ).withColumn("bucket", shuffle_bucket(seed, F.floor(F.log1p("words") * 64)))
    sizes = packed.groupBy(*SOURCE).agg(F.sum("words").alias("source_size"))
    sources = pin(
        weights(sizes).withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    )
    total = sources.df.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    targets = water_fill(sources.df, share * total).select(*SOURCE, "source_size", "target")
    ordered = running_total(packed, SOURCE, "bucket", ["key", "words"], F.col("words"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    repeats = F.coalesce(F.floor(rate), F.lit(0))
    rest = F.col("target") - repeats * F.col("source_size")
    extra = (rest > 0) & (2 * F.col("before") + F.col("words") <= 2 * rest)
    taken = ordered.join(F.broadcast(targets) if sources.small else targets, SOURCE)
    return replace_columns(
        taken.withColumn("copies", repeats + extra.cast("int")),
        docs,
        "source_size",
        "target",
        "copies",
    )


def query(spark, sf_dir) -> DataFrame:
    light = documents(spark, sf_dir).select(
        "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    return mix(pin(light).df, "size").select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )


SQL = """
    WITH docs AS (
        SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS name,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
               md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
          FROM documents),
    sources AS (
        SELECT no_source, name, CAST(sum(size) AS BIGINT) AS source_size,
               [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY no_source, name) - 1) % 3]
                   ::DOUBLE AS weight
          FROM docs GROUP BY no_source, name),
    filled AS (
        -- Sources by the level at which they reach their cap; with the first of
        -- them at their caps, the level of the others.
        SELECT *, 2.0::DOUBLE * source_size AS cap,
               (1.5::DOUBLE * sum(source_size) OVER ()
                  - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
                 / sum(weight) OVER after AS level
          FROM sources
        WINDOW before AS (ORDER BY source_size / weight, no_source, name
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               after AS (ORDER BY source_size / weight, no_source, name
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    targets AS (
        SELECT no_source, name, source_size,
               least(cap, weight * (SELECT level FROM filled f
                                     WHERE f.level * f.weight < f.cap
                                     ORDER BY source_size / weight, no_source, name
                                     LIMIT 1)) AS target
          FROM filled),
    placed AS (
        SELECT d.*, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END
                   AS repeats,
               coalesce(sum(size) OVER (PARTITION BY d.no_source, d.name ORDER BY key, size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM docs d JOIN targets t ON t.no_source = d.no_source AND t.name = d.name)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target,
           CAST(size * (repeats + CASE WHEN target > repeats * source_size
                AND 2 * before + size <= 2 * (target - repeats * source_size)
                THEN 1 ELSE 0 END) AS BIGINT) AS taken
      FROM placed"""
