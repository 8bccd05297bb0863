import sys
from contextlib import contextmanager
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerline.functions.pinning import clear_pins  # noqa: E402
from tests import edge_rows  # noqa: E402

TEST_TABLES = ("orders", "lineitem", "customer")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_pins(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Sets session options inside a `with` block."""

    @contextmanager
    def apply(**options):
        names = {key.replace("__", "."): value for key, value in options.items()}
        before = {name: spark.conf.get(name) for name in names}
        try:
            for name, value in names.items():
                spark.conf.set(name, value)
            yield
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)

    return apply


@pytest.fixture
def no_broadcast(conf):
    """Joins as for tables beyond the broadcast limit."""
    with conf(spark__sql__autoBroadcastJoinThreshold="-1"):
        yield


@pytest.fixture(params=["broadcast", "no_broadcast"])
def each_size(request):
    """Runs the test once with small join sides and once with large ones."""
    if request.param == "no_broadcast":
        request.getfixturevalue("no_broadcast")


@pytest.fixture(scope="session")
def edge(spark):
    """The hand-made tables as DataFrames, by short names."""
    frames = {
        name: spark.createDataFrame(rows, edge_rows.SCHEMAS[name])
        for name, rows in edge_rows.ROWS.items()
    }
    return arguments(frames)


def arguments(frames):
    """Named tables as the arguments of the operators."""
    tables = SimpleNamespace(
        batches=frames["load_batches"],
        balances=frames["general_balances"],
        microfinance=frames["microfinance_balances"],
        entities=frames["entity_sources"],
        codes=frames["source_codes"],
    )
    tables.report = (tables.batches, tables.balances, tables.entities, tables.codes)
    tables.refresh = (
        tables.batches,
        tables.balances,
        tables.microfinance,
        tables.codes,
    )
    return tables


@pytest.fixture(scope="session")
def duck():
    """A function that opens DuckDB on one folder of test data."""

    def open_on(sf_dir):
        connection = duckdb.connect()
        for table in TEST_TABLES:
            path = f"{sf_dir}/{table}.parquet"
            connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
        return connection

    return open_on


def rows_by_name(table):
    """Rows of an Arrow table, sorted, with columns ordered by name."""
    names = sorted(table.column_names)
    rows = zip(*(table.column(name).to_pylist() for name in names), strict=True)
    return names, sorted(rows, key=repr)
