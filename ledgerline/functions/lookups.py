"""Source codes, looked up by name."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_code(codes: DataFrame, name: str) -> Column:
    """Code of the source called `name`, as a scalar subquery.

    An unknown name gives NULL, so a comparison with it keeps no row. A name
    listed twice makes the query fail.
    """
    return codes.where(F.col("name") == name).select("code").scalar()


def reject_repeated_names(codes: DataFrame) -> None:
    """Raise ValueError when a source name is listed more than once."""
    repeated = codes.groupBy("name").count().where(F.col("count") > 1).first()
    if repeated:
        raise ValueError(f"source name listed more than once: {repeated['name']!r}")
