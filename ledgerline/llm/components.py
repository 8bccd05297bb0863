"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.joins import apart
from ledgerline.functions.pinning import pin


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node can reach, as (node, root).

    `edges` has columns a and b of one ordered type, without nulls; direction,
    repetition and loops do not matter. Only nodes with an edge to another node are
    returned.

    Alternates two steps until nothing changes: every node passes its smallest
    neighbour to its larger ones, then to its smaller ones. Both keep components
    and end in stars around the smallest node, in a number of rounds that grows
    with the logarithm of a component's size. Each round is stored, so a lost
    executor costs one round at most.
    """
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    stored = pin(links.distinct())
    before = None
    while True:
        now = (stored.rows, stored.df.agg(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[0])
        if now == before:
            return stored.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        stored = pin(_to_smaller(_to_larger(stored.df)))


def _to_larger(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy(*apart("a")).agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = both.join(least.select("a", "low"), "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _to_smaller(links: DataFrame) -> DataFrame:
    # Every link goes from the larger node a to the smaller b.
    least = links.groupBy(*apart("a")).agg(F.min("b").alias("low")).select("a", "low")
    passed = links.join(least, "a").where("b > low").select(F.col("b").alias("a"), "low")
    return passed.union(least).distinct().select("a", F.col("low").alias("b"))
