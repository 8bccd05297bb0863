"""Schemas of the five input tables."""

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


LOAD_BATCHES = _table(
    batch_id=LongType(),
    entity_id=LongType(),
    period_date=DateType(),
    cancelled_at=DateType(),
    source_type=IntegerType(),
    file_name=StringType(),
)
GENERAL_BALANCES = _table(
    batch_id=LongType(),
    person_id=LongType(),
    balance_id=LongType(),
    period_date=DateType(),
)
MICROFINANCE_BALANCES = _table(
    person_id=LongType(),
    balance_id=LongType(),
    entity_id=LongType(),
)
ENTITY_SOURCES = _table(
    entity_id=LongType(),
    description=StringType(),
    status=IntegerType(),
)
SOURCE_CODES = _table(name=StringType(), code=IntegerType())

# The operators compare keys and dates with =, MAX and IS NULL only, so these
# types work in place of the declared ones: keys beyond 18 digits, and dates
# that carry a time of day.
ALSO_ACCEPTED: dict[DataType, tuple[DataType, ...]] = {
    LongType(): (DecimalType(38, 0),),
    DateType(): (TimestampNTZType(),),
}
