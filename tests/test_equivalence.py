"""The operators against the rules in plain Python, on small random rows."""

import random
from collections import Counter
from datetime import date

import pytest

from ledgerline import (
    batch_periods,
    batch_periods_sql,
    latest_batch_report,
    latest_batches,
    refresh_batch_periods,
)
from ledgerline.plans.standin import SOURCE_NAME
from tests.conftest import arguments
from tests.edge_rows import SCHEMAS

MONTHS = [date(2024, month, 28) for month in range(1, 6)]


def _rows(seed):
    rng = random.Random(seed)

    def some(values, null=0.15):
        return None if rng.random() < null else rng.choice(values)

    return {
        "load_batches": [
            (n, some(range(6)), some(MONTHS), some(MONTHS, null=0.7), 8, some(["a", "b", "c", "d"]))
            for n in range(60)
        ]
        + [(some(range(60)), some(range(6)), some(MONTHS), None, 3, "x") for _ in range(20)],
        "general_balances": [
            (some(range(60)), some(range(5)), some(range(3)), some(MONTHS)) for _ in range(300)
        ],
        "microfinance_balances": [(some(range(5)), some(range(3)), some(range(6))) for _ in range(40)],
        "entity_sources": [(some(range(6)), some(["p", "q"]), some([0, 1])) for _ in range(20)],
        "source_codes": [(SOURCE_NAME, 8)],
    }


def _largest(values):
    return max((v for v in values if v is not None), default=None)


def _latest(rows, entity=None):
    """Entity to its latest batch id and file name."""
    valid = [r for r in rows["load_batches"] if r[3] is None and r[4] == 8]
    found = {}
    for wanted in {r[1] for r in valid}:
        if entity is not None and wanted != entity:
            continue
        own = [r for r in valid if r[1] == wanted]
        newest = _largest(r[2] for r in own)
        if newest is not None:
            ties = [r for r in own if r[2] == newest]
            found[wanted] = _largest(r[0] for r in ties), _largest(r[5] for r in ties)
    return found


def _report(rows, entity=None):
    found = Counter()
    for owner, (batch, name) in _latest(rows, entity).items():
        periods = [r[3] for r in rows["general_balances"] if r[0] == batch]
        active = {r[1] for r in rows["entity_sources"] if owner is not None and r[0] == owner and r[2] == 1}
        if periods:
            found.update((owner, text, _largest(periods), name, batch) for text in active)
    return found


def _new_period(rows, batch, entity):
    covered = {r for r in rows["microfinance_balances"] if None not in r}
    if None in (batch, entity):
        return None
    return _largest(
        day
        for number, person, balance, day in rows["general_balances"]
        if number == batch and (person, balance, entity) in covered
    )


@pytest.fixture(params=range(3))
def case(request, spark):
    rows = _rows(request.param)
    frames = {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}
    return rows, arguments(frames)


def _counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.usefixtures("each_size")
def test_latest_batches_and_report_follow_the_rules(case):
    rows, tables = case
    found = {r.entity_id: (r.batch_id, r.file_name) for r in latest_batches(tables.batches, 8).collect()}
    assert found == _latest(rows)
    assert _counted(latest_batch_report(*tables.report, SOURCE_NAME)) == _report(rows)
    one = latest_batch_report(*tables.report, SOURCE_NAME, entity=3)
    assert _counted(one) == _report(rows, 3)


@pytest.mark.usefixtures("each_size")
def test_refresh_follows_the_rules(case):
    rows, tables = case
    source = {r[0]: _new_period(rows, r[0], r[1]) for r in rows["load_batches"] if r[4] == 8}
    for periods in (batch_periods, batch_periods_sql):
        assert _counted(periods(*tables.refresh, SOURCE_NAME)) == Counter(source.items())
    wanted = Counter(
        (*r[:2], source[r[0]] if r[0] in source else r[2], *r[3:]) for r in rows["load_batches"]
    )
    assert _counted(refresh_batch_periods(*tables.refresh, SOURCE_NAME)) == wanted
