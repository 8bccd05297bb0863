"""The latest batches with their balances and their entity's description."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.filters import equal_to, like, of_keys, within
from ledgerline.functions.joins import apart
from ledgerline.functions.lookups import source_code
from ledgerline.functions.pinning import Pinned, broadcast_limit, pin
from ledgerline.operators.latest import latest_batches

ACTIVE = 1

REPORT_COLUMNS = ["entity_id", "description", "global_period", "file_name", "batch_id"]


def latest_balances(latest: DataFrame, balances: DataFrame) -> DataFrame:
    """The balances of every latest batch, of whatever entity they are."""
    keys = pin(latest.select("entity_id", "batch_id"), bounds="batch_id")
    # The join itself drops the others before a shuffle when the keys are broadcast.
    near = (within if keys.small else of_keys)(balances, keys, "batch_id")
    return near.join(keys.side, "batch_id").select(
        "entity_id", "batch_id", "person_id", "balance_id", "period_date"
    )


def global_periods(latest: DataFrame, balances: DataFrame) -> DataFrame:
    """The newest balance period of every entity's latest batch."""
    keys = pin(latest.select("entity_id", "batch_id"), bounds="batch_id")
    return _with_global_period(keys, balances).select(
        "entity_id", "batch_id", "global_period"
    )


def active_descriptions(latest: DataFrame, entities: DataFrame) -> DataFrame:
    """Every latest batch with each description of its active entity rows."""
    keys = pin(latest.select("entity_id", "batch_id"), bounds="batch_id")
    return _describe(keys.df, keys.small, entities).select(
        "entity_id", "batch_id", "description"
    )


def latest_batch_report(
    batches: DataFrame,
    balances: DataFrame,
    entities: DataFrame,
    codes: DataFrame,
    source_name: str,
    entity: int | None = None,
) -> DataFrame:
    """Latest batch of every entity, with global period and descriptions.

    Entities whose latest batch has no balance, or that have no active row, are
    left out. Rows are ordered by entity; within an entity by description.
    """
    latest = pin(
        latest_batches(batches, source_code(codes, source_name), entity), bounds="batch_id"
    )
    if entity is not None:
        entities = equal_to(entities, "entity_id", entity)
    dated = _with_global_period(latest, balances)
    # One column more than was measured is broadcast.
    small = latest.bytes + 16 * latest.rows <= broadcast_limit(dated.sparkSession)
    # The second sort key lets an entity with many descriptions span partitions.
    return (
        _describe(dated, small, entities)
        .select(REPORT_COLUMNS)
        .orderBy(F.col("entity_id").asc_nulls_last(), "description")
    )


def _with_global_period(latest: Pinned, balances: DataFrame) -> DataFrame:
    """Add the newest balance period to latest batches that have balances.

    Balances of other batches go before anything is shuffled, whatever the size of
    `latest`; the rest is reduced to one row per batch.
    """
    newest = F.max("period_date").alias("global_period")
    found = of_keys(balances, latest, "batch_id").groupBy(*apart("batch_id")).agg(newest)
    found = found.select("batch_id", "global_period")
    # What is found has no more rows than there are latest batches, of two columns.
    if 24 * latest.rows <= broadcast_limit(found.sparkSession):
        found = F.broadcast(found)
    return latest.df.join(found, "batch_id")


def _describe(latest: DataFrame, small: bool, entities: DataFrame) -> DataFrame:
    """Join the distinct descriptions of active rows; one row per description.

    `latest` has one row per entity.
    """
    active = entities.where(F.col("status") == ACTIVE).select(
        "entity_id", "description"
    )
    if small:
        return active.join(F.broadcast(latest), "entity_id").distinct()
    return like(active, latest, ["entity_id"]).distinct().join(latest, "entity_id")
