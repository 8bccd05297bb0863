"""Helpers that several of the text operators share."""

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The characters that separate words, as a regular expression class.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"
BLANKS = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: Column | str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    # lower() has a fast path for ASCII and would change other letters too.
    only_ascii = F.octet_length(text) == F.char_length(text)
    plain = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(only_ascii, F.lower(text)).otherwise(plain)


def replace_columns(rows: DataFrame, source: DataFrame, *new: str) -> DataFrame:
    """`row.*` of `rows` with the columns `new` added.

    `source` is what was packed into `row`. A column of it that has the name of
    a new one gives way.
    """
    kept = [
        F.col("row").getField(name).alias(name)
        for name in source.columns
        if name.lower() not in new
    ]
    return rows.select(*kept, *new)


def running_total(
    rows: DataFrame, groups: list[str], bucket: str, order: list[str], value: Column
) -> DataFrame:
    """Add `before`: the sum of `value` over the rows of the group that come first.

    Rows of a group are ordered by `bucket`, then by `order`. A window holds the
    rows of one bucket only; what the buckets before it add up to comes from a
    table with one row per group and bucket. The number of buckets must be
    bounded, as one task orders those of a group. No column may be null in
    `groups` and `bucket`.
    """
    rows = rows.withColumn("value", value)
    first = Window.unboundedPreceding
    sums = rows.groupBy(*groups, bucket).agg(F.sum("value").alias("total"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(first, -1)
    offsets = sums.select(
        *groups, bucket, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(first, -1)
    within = rows.withColumn("within", F.coalesce(F.sum("value").over(inside), F.lit(0)))
    return (
        within.join(offsets, [*groups, bucket])
        .withColumn("before", F.col("offset") + F.col("within"))
        .drop("value", "within", "offset")
    )
