"""Batch-load analytics on Spark: latest batches, their report, period refresh."""

from ledgerline.functions.lookups import source_code
from ledgerline.functions.pinning import clear_pins, pins
from ledgerline.operators.latest import (
    at_entity_maximum,
    eligible_batches,
    latest_batches,
    with_entity_maximum,
)
from ledgerline.operators.refresh import (
    batch_periods,
    batch_periods_sql,
    newest_covered_periods,
    refresh_batch_periods,
)
from ledgerline.operators.report import (
    active_descriptions,
    global_periods,
    latest_balances,
    latest_batch_report,
)
from ledgerline.plans.refresh_report import refresh_stored, refresh_then_report
from ledgerline.sources.tables import conform, load_table
from ledgerline.sources.versions import StaleVersionError, VersionedTable

__all__ = [
    "StaleVersionError",
    "VersionedTable",
    "active_descriptions",
    "at_entity_maximum",
    "batch_periods",
    "batch_periods_sql",
    "clear_pins",
    "conform",
    "eligible_batches",
    "global_periods",
    "latest_balances",
    "latest_batch_report",
    "latest_batches",
    "load_table",
    "newest_covered_periods",
    "pins",
    "refresh_batch_periods",
    "refresh_stored",
    "refresh_then_report",
    "source_code",
    "with_entity_maximum",
]
