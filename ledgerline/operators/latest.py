"""The latest valid batch of every entity."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.filters import equal_to
from ledgerline.functions.pinning import Pinned, pin


def eligible_batches(
    batches: DataFrame, source_code: Column | int, entity: int | None = None
) -> DataFrame:
    """Non-cancelled batches of one source type, of one entity or of all."""
    kept = batches.where(
        F.col("cancelled_at").isNull() & (F.col("source_type") == source_code)
    )
    if entity is not None:
        kept = equal_to(kept, "entity_id", entity)
    return kept.select("batch_id", "entity_id", "period_date", "file_name")


def latest_batches(
    batches: DataFrame, source_code: Column | int, entity: int | None = None
) -> DataFrame:
    """Largest batch id and largest file name at each entity's newest period.

    The two maxima are independent: with ties at the newest period they may come
    from different batches. Periods that are NULL never count, so an entity with
    no other period has no row.

    Comparing (period, value) pairs yields both maxima in one pass over the
    batches and one shuffle of partial results, with no task that holds an
    entity whole.
    """
    dated = eligible_batches(batches, source_code, entity).where(
        F.col("period_date").isNotNull()
    )

    def at_newest(column: str) -> Column:
        return F.max(F.struct("period_date", column))[column].alias(column)

    return dated.groupBy("entity_id").agg(at_newest("batch_id"), at_newest("file_name"))


def with_entity_maximum(eligible: DataFrame) -> DataFrame:
    """Every batch with the newest period of its entity."""
    newest = _newest_periods(eligible)
    rows, top = eligible.alias("rows"), newest.side.alias("top")
    same_entity = F.col("rows.entity_id").eqNullSafe(F.col("top.entity_id"))
    return rows.join(top, same_entity).select(
        "rows.batch_id", "rows.entity_id", "rows.period_date", "top.max_period"
    )


def at_entity_maximum(eligible: DataFrame) -> DataFrame:
    """The batches at their entity's newest period, all ties included."""
    newest = _newest_periods(eligible)
    rows, top = eligible.alias("rows"), newest.side.alias("top")
    same_entity = F.col("rows.entity_id").eqNullSafe(F.col("top.entity_id"))
    at_newest = F.col("rows.period_date") == F.col("top.max_period")
    return rows.join(top, same_entity & at_newest, "left_semi")


def _newest_periods(eligible: DataFrame) -> Pinned:
    # One row per entity. A window would need all rows of an entity in one task.
    return pin(
        eligible.groupBy("entity_id").agg(F.max("period_date").alias("max_period"))
    )
