"""Refresh the batch periods, then report on the refreshed table."""

from pyspark.sql import DataFrame

from ledgerline.operators.refresh import changed_periods, refresh_batch_periods, with_periods
from ledgerline.operators.report import latest_batch_report
from ledgerline.sources.versions import VersionedTable


def refresh_then_report(
    batches: DataFrame,
    balances: DataFrame,
    microfinance: DataFrame,
    entities: DataFrame,
    codes: DataFrame,
    source_name: str,
    entity: int | None = None,
    store: VersionedTable | None = None,
    base: int | None = None,
) -> DataFrame:
    """Report on refreshed batches; with `store`, on the version written there.

    `base` is the version of the store that `batches` was read from; the write is
    refused if there is a newer one, and leaves the parts of the table as they are whose
    periods do not change. The report reads the refreshed table once, so
    without a store nothing is computed twice.
    """
    if store is not None:
        refreshed = store.read(refresh_stored(store, base, balances, microfinance, codes, source_name))
    else:
        refreshed = refresh_batch_periods(batches, balances, microfinance, codes, source_name)
    return latest_batch_report(
        refreshed, balances, entities, codes, source_name, entity
    )


def refresh_stored(
    store: VersionedTable,
    base: int,
    balances: DataFrame,
    microfinance: DataFrame,
    codes: DataFrame,
    source_name: str,
) -> int:
    """Store the refresh of version `base` as the next one; return its number.

    Only the parts of the table are written in whose range of batch ids a period changes.
    """
    batches = store.read(base)
    changed = changed_periods(batches, balances, microfinance, codes, source_name)
    return store.update(base, changed, lambda rows: with_periods(rows, changed))
