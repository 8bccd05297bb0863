"""Inputs that must be refused, and names that are not known."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import UnsupportedOperationException

from ledgerline import (
    batch_periods,
    eligible_batches,
    latest_batch_report,
    refresh_batch_periods,
    source_code,
)
from ledgerline.functions.lookups import reject_repeated_names
from ledgerline.operators.refresh import merge_batch_periods
from tests import edge_rows
from tests.edge_rows import SOURCE


def test_repeated_source_batch_is_refused(spark, edge):
    again = [(103, 77, None, None, 8, "again.csv")]
    batches = edge.batches.union(
        spark.createDataFrame(again, edge_rows.SCHEMAS["load_batches"])
    )
    with pytest.raises(ValueError, match="batch 103"):
        refresh_batch_periods(batches, *edge.refresh[1:], SOURCE)


def test_unknown_source_reports_nothing_and_changes_nothing(edge):
    assert latest_batch_report(*edge.report, "NO SUCH").isEmpty()
    assert batch_periods(*edge.refresh, "NO SUCH").isEmpty()
    refreshed = refresh_batch_periods(*edge.refresh, "NO SUCH")
    assert sorted(refreshed.collect(), key=repr) == sorted(
        edge.batches.collect(), key=repr
    )


def test_repeated_source_name_is_refused(spark, edge):
    codes = edge.codes.union(edge.codes)
    with pytest.raises(ValueError, match=SOURCE):
        reject_repeated_names(codes)
    with pytest.raises(Py4JJavaError, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        eligible_batches(edge.batches, source_code(codes, SOURCE)).collect()


def test_parquet_tables_cannot_be_merged_in_place(spark, edge, tmp_path):
    table = "merge_target"
    spark.sql(
        f"CREATE TABLE {table} (batch_id BIGINT, period_date DATE) "
        f"USING parquet LOCATION '{tmp_path}/{table}'"
    )
    try:
        with pytest.raises(UnsupportedOperationException, match="MERGE INTO TABLE"):
            merge_batch_periods(batch_periods(*edge.refresh, SOURCE), table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_periods_of_two_types_are_refused(edge):
    balances = edge.balances.withColumn(
        "period_date", edge.balances["period_date"].cast("timestamp_ntz")
    )
    with pytest.raises(ValueError, match="periods of two types: date and timestamp_ntz"):
        refresh_batch_periods(edge.batches, balances, *edge.refresh[2:], SOURCE)
