"""Grouping one side of a join so that the join stays splittable."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def apart(*keys: str) -> list[str | Column]:
    """Grouping keys for a table that is joined on `keys` afterwards.

    They make the same groups as `keys` but another partitioning. AQE splits the
    partition of a hot key only where both sides of a join come straight from a
    shuffle. A side grouped by the join keys themselves is already partitioned by
    them, so Spark adds no shuffle, the aggregate stands in between, and a hot
    key of the other side stays in one task.
    """
    return [*keys, F.xxhash64(*keys).alias("group_hash")]
