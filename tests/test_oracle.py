"""Every registered query against its SQL in DuckDB."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_points
from ledgerline.operators import latest, refresh, report
from ledgerline.plans import registry
from ledgerline.plans.refresh_report import refresh_then_report
from ledgerline.plans.standin import SOURCE_NAME
from ledgerline.schemas import LOAD_BATCHES
from tests.conftest import arguments, rows_by_name
from tests.edge_rows import SCHEMAS

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
NAMES = sorted(registry.queries())

# Row counts of the views at MEDIUM.
EXPECTED_ROWS = {
    "source_code_lookup": 1,
    "scan_eligible_batches": 3967,
    "max_period_per_entity": 3967,
    "latest_period_batches": 126,
    "latest_batch_per_entity": 100,
    "join_batch_balances": 391,
    "global_period_by_entity": 100,
    "active_entity_join": 160,
    "latest_batch_report": 160,
    "latest_batch_report_one": 2,
    "balances_in_microfinance": 13522,
    "refresh_source": 5981,
    "refresh_source_correlated": 5981,
    "refresh_merged_table": 15000,
    "refresh_then_report": 160,
    "stored_refresh": 15000,
}


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_at_medium_scale(spark, duck, name):
    found = registry.queries()[name](spark, MEDIUM).toArrow()
    wanted = duck(MEDIUM).sql(registry.oracle_sql()[name]).to_arrow_table()
    assert rows_by_name(found) == rows_by_name(wanted)
    assert {f.name: f.type for f in found.schema} == {
        f.name: f.type for f in wanted.schema
    }
    assert found.num_rows == EXPECTED_ROWS.get(name, found.num_rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_with_large_join_sides(spark, duck, no_broadcast, name):
    found = registry.queries()[name](spark, SMALL).toArrow()
    wanted = duck(SMALL).sql(registry.oracle_sql()[name]).to_arrow_table()
    assert rows_by_name(found) == rows_by_name(wanted)


def test_the_looked_up_code_is_that_of_the_data(spark, tmp_path):
    rows = [("7-HIGH",), ("7-ODD",), ("1-LOW",), ("7-HIGH",)]
    orders = spark.createDataFrame(rows, "o_orderpriority string")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = registry.queries()["source_code_lookup"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [("HIGH", 7), ("ODD", 7)]


def test_entry_reports_in_order(spark):
    found = entry_points.entry(spark).collect()
    assert len(found) == 32
    ids = [row.entity_id for row in found]
    assert ids == sorted(ids)


def test_report_has_one_batch_per_entity(spark):
    found = registry.queries()["latest_batch_report"](spark, MEDIUM).collect()
    batches = {}
    for row in found:
        batches.setdefault(row.entity_id, set()).add(
            (row.batch_id, row.file_name, row.global_period)
        )
    assert all(len(kinds) == 1 for kinds in batches.values())


# Random tables, full of ties, repeats and NULLs.


def _random_tables(seed):
    random = np.random.default_rng(seed)

    def some(values, n, null=0.1):
        picked = random.choice(len(values), n)
        empty = random.random(n) < null
        return [None if e else values[p] for p, e in zip(picked, empty, strict=True)]

    months = [np.datetime64(f"2024-{m:02d}-28").astype(object) for m in range(1, 7)]
    n = 120
    # Ids of the source's batches are unique; other sources reuse them.
    columns = {
        "load_batches": (
            list(range(n)) + some(range(n), 40),
            some(range(8), n + 40),
            some(months, n + 40),
            some(months, n + 40, null=0.7),
            [8 if i < n else 3 for i in range(n + 40)],
            some([f"f{i}.csv" for i in range(9)], n + 40),
        ),
        "general_balances": (
            some(range(n), 900),
            some(range(6), 900),
            some(range(4), 900),
            some(months, 900),
        ),
        "microfinance_balances": (
            some(range(6), 60),
            some(range(4), 60),
            some(range(8), 60),
        ),
        "entity_sources": (
            some(range(8), 40),
            some(["a", "b", "c"], 40),
            some([0, 1], 40),
        ),
        "source_codes": ([SOURCE_NAME, "OTHER"], [8, 3]),
    }
    return {
        name: pa.table(
            dict(zip(SCHEMAS[name].names, values, strict=True)),
            schema=_arrow_schema(SCHEMAS[name]),
        )
        for name, values in columns.items()
    }


def _arrow_schema(schema):
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "date": pa.date32()}
    return pa.schema(
        [(f.name, kinds.get(f.dataType.simpleString(), pa.string())) for f in schema]
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.usefixtures("each_size")
def test_operators_on_random_tables(spark, tmp_path, seed):
    import duckdb

    connection = duckdb.connect()
    frames = {}
    for name, table in _random_tables(seed).items():
        connection.register(name, table)
        pq.write_table(table, tmp_path / f"{name}.parquet")
        frames[name] = spark.read.schema(SCHEMAS[name]).parquet(
            str(tmp_path / f"{name}.parquet")
        )
    tables = arguments(frames)
    newest = latest.latest_batches(tables.batches, 8)
    eligible = latest.eligible_batches(tables.batches, 8)
    results = {
        "max_period_per_entity": latest.with_entity_maximum(eligible),
        "latest_period_batches": latest.at_entity_maximum(eligible),
        "latest_batch_per_entity": newest,
        "join_batch_balances": report.latest_balances(newest, tables.balances),
        "global_period_by_entity": report.global_periods(newest, tables.balances),
        "active_entity_join": report.active_descriptions(newest, tables.entities),
        "latest_batch_report": report.latest_batch_report(*tables.report, SOURCE_NAME),
        "balances_in_microfinance": refresh.newest_covered_periods(
            tables.batches, tables.balances, tables.microfinance
        ),
        "refresh_source": refresh.batch_periods(*tables.refresh, SOURCE_NAME),
        "refresh_source_correlated": refresh.batch_periods_sql(
            *tables.refresh, SOURCE_NAME
        ),
        "refresh_merged_table": refresh.refresh_batch_periods(
            *tables.refresh, SOURCE_NAME
        ),
        "refresh_then_report": refresh_then_report(
            *tables.refresh[:3], tables.entities, tables.codes, SOURCE_NAME
        ),
    }
    for name, found in results.items():
        wanted = connection.sql(registry._ORACLE[name]).to_arrow_table()
        assert rows_by_name(found.toArrow()) == rows_by_name(wanted), name
    assert results["refresh_merged_table"].schema.names == LOAD_BATCHES.names
