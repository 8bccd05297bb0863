"""Filters on keys: ranges, Bloom tables, raw columns, shared batches, small sources."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline import conform, latest_batch_report, newest_covered_periods
from ledgerline.functions import filters
from ledgerline.functions.pinning import pin
from ledgerline.operators import refresh
from ledgerline.operators.report import global_periods
from ledgerline.schemas import GENERAL_BALANCES, MICROFINANCE_BALANCES
from tests.test_plans import _scanned, final_plan, skewed  # noqa: F401

ROWS = 600_000


def _pinned(spark, values):
    return pin(spark.createDataFrame([(v,) for v in values], "id long"), bounds="id")


def test_ranges_are_cut_at_the_largest_gaps(spark):
    rng = random.Random(1)
    clusters = [0, 10**6, 5 * 10**8, 9 * 10**17]
    values = [c + rng.randrange(50) for c in clusters for _ in range(200)]
    ranges = filters.key_ranges(_pinned(spark, values), "id")
    assert all(any(low <= v <= high for low, high in ranges) for v in values)
    assert sum(high - low + 1 for low, high in ranges) < 10**3
    assert ranges == sorted(ranges) and len(ranges) <= 32


@pytest.mark.parametrize("values", [[], [None], [7], [-(2**63), 2**63 - 1], [None, 5, 5, 6], range(-90, 90, 3)])
def test_ranges_hold_every_key(spark, values):
    keys = _pinned(spark, values)
    there = sorted({v for v in values if v is not None})
    ranges = filters.key_ranges(keys, "id")
    assert all(any(low <= v <= high for low, high in ranges) for v in there)
    rows = spark.createDataFrame([(v,) for v in [*there, 10**6, None]], "id long")
    found = [r.id for r in filters.within(rows, keys, "id").collect()]
    assert set(there) <= set(found) and None not in found
    assert 10**6 not in found or len(there) > 1


def test_one_dormant_entity_reads_few_row_groups(spark, skewed, tmp_path):  # noqa: F811
    """All latest batches lie in the last loads, but one that is old."""
    path = str(tmp_path / "by_load")
    skewed["by_record"].repartitionByRange(40, "batch_id").sortWithinPartitions("batch_id").write.parquet(path)
    latest = spark.range(ROWS - 500, ROWS).union(spark.range(1)).select(
        F.col("id").alias("entity_id"), F.col("id").alias("batch_id")
    )
    plan = global_periods(latest, spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    plan.execute().count()
    # Two of the forty files.
    assert max(_scanned(plan.executedPlan())) < ROWS / 10


@pytest.mark.parametrize("tables", [1, 5])
def test_few_strangers_pass_the_bloom_tables(spark, no_broadcast, monkeypatch, tables):
    number = 200_000
    wanted = number // filters._KEYS * filters._BLOCK_BYTES
    monkeypatch.setattr(filters, "_TABLE_BYTES", wanted // tables + 2000)
    keys = pin(spark.range(0, 3 * number, 3), bounds="id")
    parts = filters._parts(keys, "id", filters.key_ranges(keys, "id"))
    assert tables <= len(parts) <= 2 * tables
    found = filters.of_keys(spark.range(3 * number).withColumn("more", F.lit("x")), keys, "id")
    assert found.columns == ["id", "more"]
    counts = dict(found.groupBy((F.col("id") % 3 == 0).alias("is_key")).count().collect())
    assert counts[True] == number
    assert counts.get(False, 0) < 0.02 * 2 * number


def test_beyond_sixteen_tables_the_ranges_filter(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(filters, "_TABLE_BYTES", 1000)
    keys = _pinned(spark, [*range(0, 90_000, 3), 10**9])
    rows = spark.createDataFrame([(3,), (4,), (500_000_000,), (10**9,)], "id long")
    assert {3, 10**9} <= {r.id for r in filters.of_keys(rows, keys, "id").collect()} <= {3, 4, 10**9}


def test_like_drops_most_and_never_a_match(spark):
    rows = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit(1).alias("__c"))
    others = rows.where("a % 100 = 0").union(spark.sql("SELECT NULL, NULL, 1"))
    found = filters.like(rows.union(spark.sql("SELECT NULL, 3, 1")), others, ["a", "b"])
    kept = {r.a for r in found.collect()}
    assert set(range(0, 20_000, 100)) <= kept and len(kept) < 400 and None not in kept
    assert found.columns == rows.columns


@pytest.mark.parametrize("kind", ["decimal(38,10)", "decimal(12,0)", "int"])
def test_the_range_reaches_the_scan_of_an_export(spark, tmp_path, kind):
    path = str(tmp_path / "export")
    spark.range(1000).select(
        *(F.col("id").cast(kind if f.name == "batch_id" else "long").alias(f.name) for f in GENERAL_BALANCES[:3]),
        F.lit("2024-01-31").cast("date").alias("period_date"),
    ).write.parquet(path)
    balances = conform(spark.read.parquet(path), GENERAL_BALANCES)
    latest = spark.range(100, 120).select(F.col("id").alias("entity_id"), F.col("id").alias("batch_id"))
    found = global_periods(latest, balances)
    plan = final_plan(found)
    bound = {"decimal(38,10)": "100.0000000000", "decimal(12,0)": "100", "int": "100"}[kind]
    assert f"GreaterThanOrEqual(batch_id,{bound})" in plan
    assert sorted(r.batch_id for r in found.collect()) == list(range(100, 120))


def test_ranges_beyond_the_raw_type(spark):
    rows = spark.createDataFrame([(Decimal(i),) for i in (-999, 0, 999)], "batch_id decimal(3,0)")
    rows = rows.select(F.col("batch_id").cast("long"), F.col("batch_id").alias(filters.RAW + "batch_id"))
    for ranges, wanted in (
        ([(-(10**18), 0), (5000, 10**18)], {-999, 0}),
        ([(999, 10**18)], {999}),
        ([(1000, 2000)], set()),
    ):
        assert {r[0] for r in filters.in_ranges(rows, "batch_id", ranges).collect()} == wanted


def test_fractions_of_an_export_are_still_refused(spark):
    rows = spark.createDataFrame(
        [(Decimal("7.5"), 1, 1, None)], "batch_id decimal(10,2), person_id long, balance_id long, period_date date"
    )
    with pytest.raises(Exception, match="no bigint"):
        conform(rows, GENERAL_BALANCES).select("batch_id").collect()


def test_the_report_on_an_export(spark, edge):
    wanted = latest_batch_report(*edge.report, "DELINQUENCY").collect()
    exported = [
        conform(df.withColumns({c: F.col(c).cast("decimal(38,10)") for c in ("batch_id", "entity_id") if c in df.columns}), df.schema)
        for df in edge.report[:3]
    ]
    assert latest_batch_report(*exported, edge.codes, "DELINQUENCY").collect() == wanted
    refreshed = refresh.refresh_batch_periods(exported[0], exported[1], edge.microfinance, edge.codes, "DELINQUENCY")
    assert refreshed.columns == edge.batches.columns


def _largest_output(df):
    """The most rows that any operator of the run plan put out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return max(_outputs(plan.executedPlan()))


def _outputs(node):
    inner = node.plan() if "QueryStage" in node.nodeName() else node
    rows = inner.metrics().get("numOutputRows")
    children = inner.children()
    own = [rows.get().value()] if rows.isDefined() else [0]
    return own + [n for i in range(children.size()) for n in _outputs(children.apply(i))]


@pytest.mark.usefixtures("each_size")
def test_a_batch_that_many_entities_share_makes_no_product(spark):
    """10^4 entities and 10^5 balances of one batch; a record has ten entities."""
    batches = spark.range(10_000).selectExpr("1 AS batch_id", "id AS entity_id").union(
        spark.range(2, 60).selectExpr("id AS batch_id", "id AS entity_id")
    )
    balances = spark.range(100_000).selectExpr(
        "CASE WHEN id < 99000 THEN 1 ELSE 2 + id % 60 END AS batch_id",
        "id % 1000 AS person_id",
        "1L AS balance_id",
        "date_add(DATE '2024-01-01', CAST(id % 300 AS INT)) AS period_date",
    )
    microfinance = spark.range(10_000).selectExpr("id % 1000 AS person_id", "1L AS balance_id", "id AS entity_id")
    found = newest_covered_periods(batches.selectExpr("CAST(batch_id AS LONG) batch_id", "entity_id"), balances, microfinance)
    assert _largest_output(found) < 500_000
    plain = (
        balances.join(microfinance, ["person_id", "balance_id"])
        .join(batches, ["batch_id", "entity_id"])
        .groupBy("batch_id", "entity_id")
        .agg(F.max("period_date").alias("period_date"))
    )
    assert sorted(found.collect()) == sorted(plain.collect()) and found.count() > 5000


def test_shuffled_microfinance_falls_with_the_source(spark, tmp_path):
    path = str(tmp_path / "microfinance")
    spark.range(200_000).selectExpr(
        "id AS person_id", "id % 3 AS balance_id", "id % 500 AS entity_id"
    ).write.parquet(path)
    microfinance = spark.read.schema(MICROFINANCE_BALANCES).parquet(path)
    balances = spark.range(200_000).selectExpr(
        "id % 1000 AS batch_id", "id AS person_id", "id % 3 AS balance_id", "DATE '2024-01-31' AS period_date"
    )
    shuffled = []
    for number in (1, 100):
        batches = spark.range(number).selectExpr("id AS batch_id", "id % 500 AS entity_id")
        found = newest_covered_periods(batches, balances, microfinance)
        plan = found._jdf.queryExecution().executedPlan()
        plan.execute().count()
        shuffled.append(_written(plan.executedPlan(), "balance_id"))
        assert found.count() == number
    # Of 200,000: the records of the source's entities that its balances may have.
    assert shuffled[0] < 500 and shuffled[1] < 60_000


def _written(node, column):
    """Rows written by shuffles whose columns begin with a record."""
    inner = node.plan() if "QueryStage" in node.nodeName() else node
    children = inner.children()
    own = 0
    written = inner.metrics().get("shuffleRecordsWritten")
    if written.isDefined() and column in inner.output().mkString(","):
        own = written.get().value()
    return max([own, *(_written(children.apply(i), column) for i in range(children.size()))])
