"""Each rule on the hand-made tables, with small and with large join sides."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline import (
    active_descriptions,
    at_entity_maximum,
    batch_periods,
    batch_periods_sql,
    eligible_batches,
    global_periods,
    latest_balances,
    latest_batch_report,
    latest_batches,
    newest_covered_periods,
    refresh_batch_periods,
    refresh_then_report,
    source_code,
    with_entity_maximum,
)
from tests import edge_rows
from tests.edge_rows import SOURCE

pytestmark = pytest.mark.usefixtures("each_size")


def tuples(df):
    return [tuple(row) for row in df.collect()]


def same(df, expected):
    assert sorted(tuples(df), key=repr) == sorted(expected, key=repr)


@pytest.fixture
def latest(edge):
    return latest_batches(edge.batches, source_code(edge.codes, SOURCE))


@pytest.fixture
def eligible(edge):
    return eligible_batches(edge.batches, source_code(edge.codes, SOURCE))


def test_eligible_batches_are_neither_cancelled_nor_of_another_source(eligible):
    same(
        eligible.select("batch_id"),
        [(101,), (102,), (103,), (106,), (201,), (301,), (401,), (501,)],
    )


def test_eligible_batches_of_one_entity(edge):
    same(
        eligible_batches(edge.batches, 8, entity=70),
        [(301, 70, date(2024, 1, 31), "g70.csv")],
    )


def test_every_batch_gets_the_newest_period_of_its_entity(eligible):
    found = {row.batch_id: row.max_period for row in with_entity_maximum(eligible).collect()}
    newest, january = date(2024, 2, 29), date(2024, 1, 31)
    assert found == {
        101: newest,
        102: newest,
        103: newest,
        106: newest,
        201: None,
        301: january,
        401: january,
        501: january,
    }


def test_batches_without_entity_share_one_maximum(spark):
    rows = [(1, None, date(2024, 1, 31), "a"), (2, None, date(2024, 2, 29), "b")]
    eligible = spark.createDataFrame(
        rows, "batch_id bigint, entity_id bigint, period_date date, file_name string"
    )
    newest = date(2024, 2, 29)
    same(
        with_entity_maximum(eligible),
        [(1, None, date(2024, 1, 31), newest), (2, None, newest, newest)],
    )
    same(at_entity_maximum(eligible), rows[1:])


def test_all_ties_at_the_newest_period_are_kept(eligible):
    same(
        at_entity_maximum(eligible).select("batch_id"),
        [(102,), (103,), (301,), (401,), (501,)],
    )


def test_batch_id_and_file_name_are_independent_maxima(latest):
    same(latest, edge_rows.LATEST)


def test_missing_file_names_and_batch_ids_do_not_hide_others(spark):
    day = date(2024, 1, 31)
    rows = [
        (1, 5, day, None, 8, None),
        (None, 5, day, None, 8, "a.csv"),
        (2, 6, day, None, 8, None),
    ]
    batches = spark.createDataFrame(rows, edge_rows.SCHEMAS["load_batches"])
    same(latest_batches(batches, 8), [(5, 1, "a.csv"), (6, 2, None)])


def test_latest_balances_are_those_of_the_batch_whatever_the_entity(edge, latest):
    same(
        latest_balances(latest, edge.balances),
        [
            (50, 103, 1, 1, date(2024, 2, 29)),
            (50, 103, 2, 1, date(2024, 3, 31)),
            (80, 401, 4, 1, date(2024, 1, 31)),
            (90, 501, 5, 1, None),
        ],
    )


def test_global_period_leaves_out_batches_without_balances(edge, latest):
    same(
        global_periods(latest, edge.balances),
        [
            (50, 103, date(2024, 3, 31)),
            (80, 401, date(2024, 1, 31)),
            (90, 501, None),
        ],
    )


def test_two_entities_may_share_their_latest_batch(spark, edge):
    latest = spark.createDataFrame(
        [(1, 103, "a"), (2, 103, "b")], "entity_id bigint, batch_id bigint, file_name string"
    )
    newest = date(2024, 3, 31)
    same(global_periods(latest, edge.balances), [(1, 103, newest), (2, 103, newest)])
    assert latest_balances(latest, edge.balances).count() == 4


def test_active_descriptions_are_distinct(edge, latest):
    same(
        active_descriptions(latest, edge.entities),
        [
            (50, 103, "Caja A"),
            (50, 103, "Caja A bis"),
            (70, 301, "No bal"),
            (90, 501, "Null GP"),
        ],
    )


def test_report(edge):
    assert tuples(latest_batch_report(*edge.report, SOURCE)) == edge_rows.REPORT


def test_report_of_one_entity(edge):
    found = latest_batch_report(*edge.report, SOURCE, entity=90)
    assert tuples(found) == edge_rows.REPORT[2:]


def test_covered_periods_of_every_pair(edge):
    same(
        newest_covered_periods(edge.batches, edge.balances, edge.microfinance),
        [
            (101, 50, date(2024, 1, 31)),
            (102, 50, date(2024, 6, 30)),
            (103, 50, date(2024, 2, 29)),
            (104, 50, date(2024, 3, 15)),
            (401, 80, date(2024, 1, 31)),
            (501, 90, None),
        ],
    )


def test_refresh_source(edge):
    same(batch_periods(*edge.refresh, SOURCE), edge_rows.REFRESH_SOURCE)


def test_refresh_source_in_sql(edge):
    same(batch_periods_sql(*edge.refresh, SOURCE), edge_rows.REFRESH_SOURCE)


def test_refresh_source_has_a_row_for_each_batch_row(spark, edge):
    """Repeated batches and batches without id or entity keep their rows."""
    extra = [
        (103, 50, None, None, 8, "again.csv"),
        (103, 99, None, None, 8, "shared.csv"),
        (None, 50, None, None, 8, "no id.csv"),
        (103, None, None, None, 8, "no entity.csv"),
    ]
    batches = edge.batches.union(
        spark.createDataFrame(extra, edge_rows.SCHEMAS["load_batches"])
    )
    expected = edge_rows.REFRESH_SOURCE + [
        (103, date(2024, 2, 29)),
        (103, date(2024, 3, 31)),
        (None, None),
        (103, None),
    ]
    same(batch_periods(batches, *edge.refresh[1:], SOURCE), expected)
    same(batch_periods_sql(batches, *edge.refresh[1:], SOURCE), expected)


def test_refresh_replaces_matched_periods_even_by_null(edge):
    refreshed = refresh_batch_periods(*edge.refresh, SOURCE)
    found = {(row.batch_id, row.entity_id): row.period_date for row in refreshed.collect()}
    assert found == edge_rows.REFRESHED_PERIODS


def test_refresh_keeps_rows_and_other_columns(edge):
    refreshed = refresh_batch_periods(*edge.refresh, SOURCE)
    assert refreshed.columns == edge.batches.columns
    same(refreshed.drop("period_date"), tuples(edge.batches.drop("period_date")))


def test_refreshing_twice_changes_nothing_more(edge):
    once = refresh_batch_periods(*edge.refresh, SOURCE)
    twice = refresh_batch_periods(once, *edge.refresh[1:], SOURCE)
    same(twice, tuples(once))


def test_batches_without_id_are_never_matched(spark, edge):
    extra = [
        (None, 50, date(2020, 1, 31), None, 8, "no id.csv"),
        (None, 50, date(2020, 2, 29), None, 8, "no id either.csv"),
    ]
    batches = edge.batches.union(
        spark.createDataFrame(extra, edge_rows.SCHEMAS["load_batches"])
    )
    refreshed = refresh_batch_periods(batches, *edge.refresh[1:], SOURCE)
    same(refreshed.where(F.col("batch_id").isNull()), extra)


def test_report_after_refresh(edge):
    found = refresh_then_report(
        edge.batches, edge.balances, edge.microfinance, edge.entities, edge.codes, SOURCE
    )
    assert tuples(found) == edge_rows.REPORT_AFTER_REFRESH
