"""Input tables, checked against their declared schemas."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    IntegralType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ledgerline import schemas
from ledgerline.functions.filters import RAW
from ledgerline.functions.lookups import reject_repeated_names

TABLES: dict[str, StructType] = {
    "load_batches": schemas.LOAD_BATCHES,
    "general_balances": schemas.GENERAL_BALANCES,
    "microfinance_balances": schemas.MICROFINANCE_BALANCES,
    "entity_sources": schemas.ENTITY_SOURCES,
    "source_codes": schemas.SOURCE_CODES,
}

# Keys that operators look up by range.
RANGE_KEYS = ("batch_id", "entity_id")


def load_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """One input table, from a Parquet folder or from the catalogue."""
    found = spark.read.parquet(path) if path else spark.table(name)
    table = conform(found, TABLES[name])
    if name == "source_codes":
        reject_repeated_names(table)
    return table


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of `df`, with empty strings read as NULL.

    Types as databases export them become the declared ones where no value is lost:
    other integers and decimals without a fraction, and timestamps, taken in the
    session's time zone. Raises ValueError when a column is missing or of another
    kind; the query fails when a number has a fraction or does not fit.

    A decimal key that operators look up by range is kept beside the converted one, in a
    column named with RAW, for filters that reach the files. A number outside of the
    range that is looked up is not read then, and not checked.
    """
    found = {field.name: field.dataType for field in df.schema}
    columns = []
    for field in schema:
        declared, kind = field.dataType, found.get(field.name)
        column = F.col(field.name)
        if kind == declared or kind in schemas.ALSO_ACCEPTED.get(declared, ()):
            if isinstance(declared, StringType):
                column = F.nullif(column, F.lit(""))
        elif isinstance(declared, IntegralType) and isinstance(kind, (IntegralType, DecimalType)):
            if isinstance(kind, DecimalType) and field.name in RANGE_KEYS:
                columns.append(column.alias(RAW + field.name))
            column = _exact(column, kind, field)
        elif isinstance(declared, DateType) and isinstance(kind, TimestampType):
            column = column.cast("timestamp_ntz")
        else:
            raise ValueError(
                f"column {field.name}: expected {declared.simpleString()}, "
                f"found {_describe(kind)}"
            )
        columns.append(column.alias(field.name))
    return df.select(columns)


def _exact(column: Column, kind: DataType, field: StructField) -> Column:
    """A number as the declared integer, or an error where that would change it."""
    if isinstance(kind, (ByteType, ShortType, IntegerType)) and isinstance(field.dataType, LongType):
        # Spark sees through a cast that loses nothing.
        return column.cast(field.dataType)
    cast = column.try_cast(field.dataType)
    text = F.concat(F.lit(f"column {field.name}: no {field.dataType.simpleString()}: "), column.cast("string"))
    return F.when(column.isNull() | (cast == column), cast).otherwise(F.raise_error(text))


def _describe(kind) -> str:
    return "none" if kind is None else kind.simpleString()
