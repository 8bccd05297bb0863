"""Hard negatives against brute force."""

import math
import random

import duckdb
import numpy as np
import pytest

from ledgerline.llm import hard_negatives as hard

SCHEMA = "vec_id long, label int, embedding array<float>, block string, place string, data string, score string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)


def _plain(rows, every=5, positives=5, negatives=5):
    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    kept = []
    for i, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((i, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for at, (i, label, vector) in enumerate(kept):
        if i is None or i % every:
            continue

        def first(alike, low, high, number):
            rows = [
                (-score(vector, v), j is None, j if j is not None else 0)
                for k, (j, other, v) in enumerate(kept)
                if k != at and (other == label) == alike
            ]
            return sorted(r for r in rows if low <= -r[0] <= high)[:number]

        for p, p_none, p_id in first(True, -math.inf, math.inf, positives):
            low, high = -(80 * p) / 100, -p
            for rank, (n, n_none, n_id) in enumerate(first(False, low, high, negatives), 1):
                found.append((i, None if p_none else p_id, rank, None if n_none else n_id, -p, -n))
    return sorted(found, key=repr)


def _found(spark, rows, every=5):
    mined = hard.mine(_frame(spark, rows), lambda vec_id: vec_id % every == 0)
    return sorted(map(tuple, mined.collect()), key=repr)


def _random_rows(seed, number, dims=12):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(number):
        near = rng.choice(centers)
        rows.append((i * 5 if i % 3 else i, rng.randrange(3), [x + rng.gauss(0, 0.3) for x in near]))
    return rows


@pytest.mark.parametrize("each_size", ["broadcast", "no_broadcast"], indirect=True)
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, each_size, monkeypatch):
    # Several blocks, and a look at the bounds after every other dimension.
    monkeypatch.setattr(hard, "BLOCK_VALUES", 300)
    monkeypatch.setattr(hard, "ANCHORS", 7)
    monkeypatch.setattr(hard, "STEP", 2)
    rows = _random_rows(seed, 260)
    wanted = _plain(rows)
    assert _found(spark, rows) == wanted and len(wanted) > 300


def test_edge_rows(spark):
    same = [0.5, 0.5, -0.25]
    rows = [
        (0, 1, same),
        (0, 1, same),
        (5, None, same),
        (10, 1, None),
        (15, 1, [0.5, None, 0.1]),
        (20, 1, [0.5, math.nan, 0.1]),
        (25, 1, [0.5, math.inf, 0.1]),
        (30, 2, []),
        (35, 2, [0.0, 0.0, 0.0]),
        (40, 2, [1.0]),
        (None, 1, same),
        (None, 2, same),
        (None, 2, same),
        (45, -3, [-0.5, -0.5, 0.25]),
        (50, -3, [0.5, 0.5, -0.25]),
        *((1000 + i, 2, same) for i in range(9)),
        *((2000 + i, 1, [0.45, 0.5, -0.25]) for i in range(9)),
    ]
    assert _found(spark, rows) == _plain(rows)


def test_nothing_gives_nothing(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(3, 1, [1.0, 2.0])]) == []
    assert _found(spark, [(5, 1, [1.0, 2.0])]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, i % 2, [3.0e6 + i * 256.0, -2.5e6, 7.0 + i]) for i in range(30)]
    assert _found(spark, rows) == _plain(rows)
    with pytest.raises(Exception, match="too large|out of bounds|Overflow"):
        _found(spark, [(i, 1, [3e30]) for i in (5, 10)])


def test_rows_leave_a_scan_early():
    rng = np.random.default_rng(3)
    anchor = np.concatenate([np.full(8, 200.0), rng.integers(-9, 9, 56)])
    columns = rng.integers(-256, 256, (64, 500)).astype(float)
    block = hard.Block(
        {"block": 1, "size": 500, "dims": 64, "ids": list(range(500)), "labels": [0] * 500, "data": columns.tobytes()}
    )
    nearest, left = hard.Nearest(5), []

    def keep(least, most):
        kept = nearest._keep(least, most)
        left.append(int(kept.sum()))
        return kept

    rows, scores = hard.scan(block, anchor, np.arange(500), keep)
    assert left[0] < 250 and left == sorted(left, reverse=True)
    exact = anchor @ columns
    best = np.argsort(-exact)[:5]
    assert set(best) <= set(rows) and (scores == exact[rows]).all()


def test_sql_gives_the_rows(spark):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    wanted = sorted(duck.sql(hard.SQL).fetchall(), key=repr)
    assert sorted(map(tuple, hard.query(spark, folder).collect()), key=repr) == wanted and wanted
