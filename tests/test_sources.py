"""Checked loading, versioned storage and pinned results."""

import os
import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerline import (
    StaleVersionError,
    VersionedTable,
    conform,
    eligible_batches,
    latest_batch_report,
    load_table,
    refresh_batch_periods,
    refresh_stored,
    refresh_then_report,
    with_entity_maximum,
)
from ledgerline.functions import hadoop, pinning
from ledgerline.functions.pinning import clear_pins, pin, pins
from ledgerline.schemas import ENTITY_SOURCES, LOAD_BATCHES
from ledgerline.sources.tables import TABLES
from tests import edge_rows
from tests.conftest import arguments
from tests.edge_rows import SOURCE


@pytest.fixture
def stored(edge, tmp_path):
    """The hand-made tables written as Parquet, by name."""
    frames = vars(edge)
    names = dict(
        batches="load_batches",
        balances="general_balances",
        microfinance="microfinance_balances",
        entities="entity_sources",
        codes="source_codes",
    )
    for short, name in names.items():
        frames[short].write.parquet(str(tmp_path / name))
    return tmp_path


def test_tables_load_from_parquet(spark, stored):
    tables = arguments({n: load_table(spark, n, str(stored / n)) for n in TABLES})
    found = latest_batch_report(*tables.report, SOURCE).collect()
    assert [tuple(row) for row in found] == edge_rows.REPORT


def test_tables_load_from_the_catalogue(spark, stored):
    spark.read.parquet(str(stored / "entity_sources")).createOrReplaceTempView(
        "entity_sources"
    )
    try:
        assert load_table(spark, "entity_sources").count() == 8
    finally:
        spark.catalog.dropTempView("entity_sources")


def test_empty_strings_are_read_as_null(spark):
    rows = [(1, "", 1), (2, " ", 1), (3, None, 1)]
    found = conform(spark.createDataFrame(rows, ENTITY_SOURCES), ENTITY_SOURCES)
    assert [row.description for row in found.collect()] == [None, " ", None]


def test_columns_are_checked_and_extra_ones_dropped(spark):
    table = spark.createDataFrame([(1, "a", 1, 9)], "entity_id long, description string, status int, more int")
    assert conform(table, ENTITY_SOURCES).columns == ENTITY_SOURCES.names
    with pytest.raises(ValueError, match="description: expected string, found none"):
        conform(table.drop("description"), ENTITY_SOURCES)
    with pytest.raises(ValueError, match="entity_id: expected bigint, found string"):
        conform(table.withColumn("entity_id", F.lit("1")), ENTITY_SOURCES)


def test_repeated_source_names_are_refused_on_load(spark, edge, tmp_path):
    path = str(tmp_path / "codes")
    edge.codes.union(edge.codes).write.parquet(path)
    with pytest.raises(ValueError, match="more than once"):
        load_table(spark, "source_codes", path)


def test_wide_keys_and_times_of_day_work(spark, edge):
    """Keys beyond 18 digits, and dates with a time."""
    big = Decimal(10) ** 30

    def wide(table):
        columns = []
        for field in table.schema:
            column = F.col(field.name)
            if field.dataType.simpleString() == "bigint":
                column = (column.cast("decimal(38,0)") + F.lit(big)).cast("decimal(38,0)")
            elif field.dataType.simpleString() == "date":
                column = column.cast("timestamp_ntz") + F.expr("INTERVAL 5 HOURS")
            columns.append(column.alias(field.name))
        return table.select(columns)

    frames = {
        name: conform(wide(spark.createDataFrame(rows, edge_rows.SCHEMAS[name])), TABLES[name])
        for name, rows in edge_rows.ROWS.items()
    }
    tables = arguments(frames)
    found = refresh_then_report(
        *tables.refresh[:3], tables.entities, tables.codes, SOURCE
    ).collect()
    assert [
        (row.entity_id - big, row.global_period, row.batch_id - big) for row in found
    ] == [(50, datetime(2024, 6, 30, 5), 102)] * 2


@pytest.fixture
def store(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "load_batches"), LOAD_BATCHES)


def test_a_table_is_refreshed_from_its_own_newest_version(edge, store):
    with pytest.raises(LookupError):
        store.read()
    assert store.write(edge.batches, base=None) == 1
    refreshed = refresh_batch_periods(store.read(), *edge.refresh[1:], SOURCE)
    assert store.write(refreshed, base=1) == 2
    assert store.versions() == [1, 2]
    periods = {(r.batch_id, r.entity_id): r.period_date for r in store.read().collect()}
    assert periods == edge_rows.REFRESHED_PERIODS
    before = sorted(store.read(1).collect(), key=repr)
    assert before == sorted(edge.batches.collect(), key=repr)


def test_a_write_from_an_old_version_is_refused(edge, store):
    store.write(edge.batches, base=None)
    store.write(edge.batches, base=1)
    for base in (None, 1, 3):
        with pytest.raises(StaleVersionError):
            store.write(edge.batches.limit(1), base=base)
    assert store.versions() == [1, 2] and store.read().count() == 11


def test_one_of_two_writers_gets_a_number(edge, store, tmp_path):
    store.write(edge.batches, base=None)
    # Another writer has started from version 1 too and is not done.
    (tmp_path / "load_batches" / "version-000002.claimed").touch()
    with pytest.raises(StaleVersionError, match="version 2 is being written"):
        store.write(edge.batches, base=1)
    assert store.versions() == [1] and store.read().count() == 11
    # It has died.
    store.release(2)
    assert store.write(edge.batches, base=1) == 2
    with pytest.raises(ValueError):
        store.release(2)


def test_an_unfinished_version_is_not_read(edge, store, tmp_path):
    store.write(edge.batches, base=None)
    # As where Spark is told to leave no success markers.
    os.remove(tmp_path / "load_batches" / "version-000001" / "_SUCCESS")
    os.makedirs(tmp_path / "load_batches" / "version-000002" / "_temporary")
    assert store.versions() == [1] and store.read().count() == 11
    assert store.write(edge.batches.limit(1), base=1) == 2
    assert store.read().count() == 1


def test_a_failed_write_gives_its_number_back(edge, store):
    broken = edge.batches.withColumn("file_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        store.write(broken, base=None)
    assert store.versions() == []
    assert store.write(edge.batches, base=None) == 1


def test_old_versions_expire(edge, store):
    store.write(edge.batches, base=None)
    for base in (1, 2, 3):
        store.write(edge.batches.limit(base), base=base)
    assert store.expire(keep=2) == [1, 2]
    assert store.versions() == [3, 4] and store.read().count() == 3
    assert store.write(edge.batches, base=4) == 5
    with pytest.raises(ValueError):
        store.expire(keep=0)


def test_empty_strings_of_a_version_are_read_as_null(spark, store):
    rows = [(1, 5, None, None, 8, "")]
    store.write(spark.createDataFrame(rows, LOAD_BATCHES), base=None)
    assert store.read().first().file_name is None


def test_a_version_must_have_the_declared_types(edge, store):
    with pytest.raises(ValueError, match="batch_id"):
        store.write(edge.batches.withColumn("batch_id", F.col("batch_id").cast("string")), None)


def test_refresh_then_report_through_a_store(edge, store):
    base = store.write(edge.batches, base=None)
    found = refresh_then_report(
        store.read(base), *edge.refresh[1:3], edge.entities, edge.codes, SOURCE, store=store, base=base
    )
    assert [tuple(row) for row in found.collect()] == edge_rows.REPORT_AFTER_REFRESH
    assert store.versions() == [1, 2]


@pytest.mark.parametrize("kind", ["smallint", "int", "decimal(18,0)", "decimal(38,0)", "decimal(38,10)"])
def test_exported_number_types_load(spark, edge, kind):
    tables = {}
    for name, rows in edge_rows.ROWS.items():
        frame = spark.createDataFrame(rows, edge_rows.SCHEMAS[name])
        numbers = [f.name for f in frame.schema if f.dataType.simpleString() in ("bigint", "int")]
        cast = frame.withColumns({c: F.col(c).cast(kind) for c in numbers})
        tables[name] = conform(cast, TABLES[name])
    found = latest_batch_report(*arguments(tables).report, SOURCE).collect()
    assert [tuple(row) for row in found] == edge_rows.REPORT


@pytest.mark.parametrize("value, kind", [("1.5", "decimal(38,10)"), ("99999999999999999999", "decimal(38,10)")])
def test_numbers_that_would_change_are_refused(spark, value, kind):
    table = spark.createDataFrame([("a", "1")], "description string, status string").select(
        F.lit(value).cast(kind).alias("entity_id"), "description", F.col("status").cast("bigint")
    )
    with pytest.raises(Exception, match="column entity_id: no bigint"):
        conform(table, ENTITY_SOURCES).collect()


def test_timestamps_load_with_their_time_of_day(spark, edge):
    def timed(table):
        return table.withColumn("period_date", F.to_timestamp("period_date"))

    batches = conform(timed(edge.batches).withColumn("cancelled_at", F.to_timestamp("cancelled_at")), LOAD_BATCHES)
    balances = conform(timed(edge.balances), TABLES["general_balances"])
    assert batches.schema["period_date"].dataType.simpleString() == "timestamp_ntz"
    found = latest_batch_report(batches, balances, edge.entities, edge.codes, SOURCE)
    assert [row.global_period for row in found.collect()] == [datetime(2024, 3, 31)] * 2 + [None]


def test_pinned_results_are_measured(spark):
    frame = spark.range(1000).select("id", F.repeat(F.lit("x"), 12).alias("text"))
    pinned = pin(frame)
    assert (pinned.rows, pinned.bytes) == (1000, 1000 * (8 + 16 + 12))
    assert sorted(pinned.df.collect()) == sorted(frame.collect())
    empty = pin(frame.limit(0))
    assert (empty.rows, empty.bytes, empty.df.count()) == (0, 0, 0)


def test_only_small_results_are_broadcast(spark, conf):
    pinned = pin(spark.range(1000))
    with conf(spark__sql__autoBroadcastJoinThreshold="16000b"):
        assert pinned.small
    with conf(spark__sql__autoBroadcastJoinThreshold="15999b"):
        assert not pinned.small
    with conf(spark__sql__autoBroadcastJoinThreshold="-1"):
        assert not pin(spark.range(0)).small


def test_bounds_are_measured_with_the_pin(spark):
    pinned = pin(spark.range(5, 9), bounds="id")
    assert (pinned.low, pinned.high) == (5, 8)
    assert pin(spark.range(0), bounds="id").low is None


def test_broadcast_limits_are_read_with_their_units(spark, conf):
    for text, number in (("10485760b", 10 << 20), ("256k", 256 << 10), ("1GB", 1 << 30), ("-1", -1), ("77", 77)):
        with conf(spark__sql__autoBroadcastJoinThreshold=text):
            assert pinning.broadcast_limit(spark) == number


def _folders(spark):
    top = spark.conf.get("spark.checkpoint.dir")
    return set(os.listdir(f"{top}/ledgerline/{spark.sparkContext.applicationId}"))


def test_a_block_deletes_its_own_pins_only(spark):
    mine = pin(spark.range(3))
    before = _folders(spark)
    with pins(spark):
        inner = pin(spark.range(4))
        assert inner.df.count() == 4 and len(_folders(spark)) == len(before) + 1
    assert _folders(spark) == before and mine.df.count() == 3


def test_clearing_one_session_leaves_results_of_another(spark, edge):
    other = spark.newSession()
    other_pin = pin(other.range(7))
    kept = with_entity_maximum(eligible_batches(edge.batches, 8))
    clear_pins(other)
    assert kept.count() == 8
    with pytest.raises(Exception, match="(?i)exist"):
        other_pin.df.count()


def test_shared_folder_is_the_one_the_session_names(spark):
    assert pinning._shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_without_one_it_is_the_warehouse():
    class Session:
        conf = {"spark.sql.warehouse.dir": "hdfs://host/warehouse/"}

    assert pinning._shared_folder(Session()) == "hdfs://host/warehouse"


def _files(store):
    root = Path(store.root)
    return {str(p.relative_to(root)) for p in root.rglob("*.parquet")}


def test_a_refresh_leaves_other_ranges_as_they_are(spark, tmp_path):
    store = VersionedTable(spark, str(tmp_path / "batches"), LOAD_BATCHES, parts=10)
    batches = spark.range(1000).selectExpr(
        "id AS batch_id", "id % 7 AS entity_id", "DATE '2024-01-31' AS period_date",
        "CAST(NULL AS DATE) AS cancelled_at", "CAST(IF(id BETWEEN 410 AND 480, 8, 3) AS INT) AS source_type",
        "concat('f', id) AS file_name",
    )
    balances = spark.range(1000).selectExpr(
        "id AS batch_id", "id AS person_id", "1L AS balance_id", "DATE '2024-03-31' AS period_date"
    )
    microfinance = spark.range(1000).selectExpr("id AS person_id", "1L AS balance_id", "id % 7 AS entity_id")
    codes = spark.sql("SELECT 'DELINQUENCY' AS name, 8 AS code")
    first = store.write(batches, None)
    before = _files(store)
    wanted = refresh_batch_periods(batches, balances, microfinance, codes, SOURCE)
    second = refresh_stored(store, first, balances, microfinance, codes, SOURCE)
    new = _files(store) - before
    assert sorted(store.read(second).collect()) == sorted(wanted.collect())
    assert sorted(store.read(first).collect()) == sorted(batches.collect())
    # Batches 410 to 480 lie in two or three of ten parts.
    assert 1 <= len({os.path.dirname(f) for f in new}) <= 3
    assert before < _files(store)
    # Nothing changes any more: no part is written.
    third = refresh_stored(store, second, balances, microfinance, codes, SOURCE)
    assert _files(store) == before | new
    clear_pins(spark)
    assert store.expire(keep=1) == [first, second]
    assert sorted(store.read(third).collect()) == sorted(wanted.collect())
    assert len(_files(store)) < len(before | new)


def test_leased_versions_do_not_expire(spark, edge, store):
    clear_pins(spark)
    for base in (None, 1, 2):
        store.write(edge.batches, base=base)
    with pins(spark):
        reading = store.read(1)
        assert store.expire(keep=1) == [2]
        assert reading.count() == 11 and store.versions() == [1, 3]
        # The lease of a reader that died long ago does not count.
        assert store.expire(keep=1, lease_seconds=-60) == [1]
    with pins(spark):
        store.read(3)
    store.write(edge.batches, base=3)
    assert store.expire(keep=1) == [3]


def test_a_late_writer_cannot_commit_an_expired_number(edge, store, monkeypatch):
    store.write(edge.batches, base=None)
    made = store._written

    def slow(*args):
        monkeypatch.setattr(store, "_written", made)
        # Others take the number, go on, and let it expire.
        store.release(2)
        store.write(edge.batches, base=1)
        store.write(edge.batches, base=2)
        store.expire(keep=1)
        return made(*args)

    monkeypatch.setattr(store, "_written", slow)
    with pytest.raises(StaleVersionError):
        store.write(edge.batches.limit(1), base=1)
    assert store.versions() == [3]


def test_empty_tables_and_null_keys_are_stored(spark, edge, store):
    store.write(edge.batches.limit(0), base=None)
    assert store.read().count() == 0
    nulls = edge.batches.withColumn("batch_id", F.lit(None).cast("long"))
    store.write(nulls, base=1)
    assert sorted(store.read().collect(), key=repr) == sorted(nulls.collect(), key=repr)


class _ObjectStore:
    """A folder whose files are created after a look, so that two writers can create one."""

    def __init__(self, root):
        self.root, self.names = root, {}

    def getUri(self):
        return SimpleNamespace(getScheme=lambda: "s3a")

    def exists(self, where):
        return True

    def createNewFile(self, where):
        new = where.name not in self.names
        time.sleep(random.random() / 50)
        self.names[where.name] = True
        return new

    def listStatus(self, where):
        path = [SimpleNamespace(getName=lambda n=n: n) for n in list(self.names)]
        return [SimpleNamespace(getPath=lambda p=p: p, getModificationTime=lambda: 0) for p in path]

    def delete(self, where, _):
        self.names.pop(where.name, None)


class _Where:
    def __init__(self, path):
        self.path, self.name = path, path.rsplit("/", 1)[1]

    def suffix(self, more):
        return _Where(self.path + more)


def test_one_writer_wins_where_files_are_not_created_atomically(monkeypatch):
    for _ in range(5):
        files = _ObjectStore("s3a://bucket/table")
        monkeypatch.setattr(hadoop, "_open", lambda spark, path, files=files: (files, _Where(path)))
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda _: hadoop.claim(None, "s3a://bucket/table/version-000002.claimed", 0.3), range(8)))
        assert sum(won) == 1 and len(files.names) == 1
        # Who comes later finds the claim.
        assert not hadoop.claim(None, "s3a://bucket/table/version-000002.claimed", 0.01)


def test_machine_local_folders_are_refused_on_a_cluster():
    for folder in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse"):

        class Session:
            conf = {"spark.sql.warehouse.dir": folder, "spark.master": "yarn"}

        with pytest.raises(ValueError, match="share"):
            pinning._shared_folder(Session())
