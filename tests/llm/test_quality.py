"""The quality classifier: statistics, densities and held-out accuracy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality
from tests.llm.conftest import documents

FOLDER = "/root/testdata/sf0.01"


def test_statistics_of_small_texts():
    named = dict(zip(quality.FEATURES, quality.statistics("The cat\nthe cat! A1 #x# NO\nthe cat".encode()), strict=True))
    share = quality._share
    assert named["words"] == math.log1p(9)
    assert named["symbols"] == share(2, 26)
    assert named["exclamations"] == share(1, 26)
    assert named["capitals"] == share(4, 26)
    assert named["digits"] == share(1, 26)
    assert named["distinct words"] == share(7, 9)
    assert named["most frequent word"] == share(2, 9)
    assert named["function words"] == share(2, 9)
    assert named["words with symbols"] == share(1, 9)
    assert named["words in capitals"] == share(2, 9)
    assert named["words a line"] == math.log1p(3)
    assert named["repeated lines"] == share(0, 3)
    for text in (b"", b" \n\t ", b"x", "é".encode(), b"!" * 100_000):
        assert np.isfinite(quality.statistics(text)).all()


def test_every_byte_counts_for_each_occurrence():
    one, two = (dict(zip(quality.FEATURES, quality.statistics(t), strict=True)) for t in (b"a# b", b"a# a# b b"))
    assert one["words with symbols"] == quality._share(1, 2)
    assert two["words with symbols"] == quality._share(2, 4)


def test_log_odds_equal_densities_written_out():
    rng = np.random.default_rng(1)
    rows = [rng.normal(size=(400, 3)) @ rng.normal(size=(3, 3)) + i for i in (0, 1)]
    classes = [quality.Moments(len(r), r.mean(axis=0), np.cov(r.T, bias=True)) for r in rows]
    found = quality.log_odds(quality.discriminant(classes, 0.2, 0.1), rows[0])
    within = (classes[0].covariance + classes[1].covariance) / 2
    wanted = 0
    for sign, c in zip((-1, 1), classes, strict=True):
        mixed = 0.8 * c.covariance + 0.2 * within
        s = 0.9 * mixed + 0.1 * np.trace(mixed) / 3 * np.eye(3)
        x = rows[0] - c.mean
        distance = np.einsum("ij,jk,ik->i", x, np.linalg.inv(s), x)
        wanted = wanted + sign * (math.log(0.5) - np.linalg.slogdet(s)[1] / 2 - distance / 2)
    assert np.allclose(found, wanted)


def test_moments_equal_numpy(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(size=(90, len(quality.FEATURES)))
    labels = (np.arange(90) % 3 == 0).astype(int)
    rows = spark.createDataFrame(
        [(v.tolist(), int(label)) for v, label in zip(values, labels, strict=True)],
        "statistics array<double>, label int",
    ).repartition(7)
    zero, one = np.zeros(values.shape[1]), np.ones(values.shape[1])
    for label, m in quality._moments(rows, zero, one, 0.8).items():
        own = np.clip(values[labels == label], -0.8, 0.8)
        assert m.n == len(own)
        assert np.allclose(m.mean, own.mean(axis=0))
        assert np.allclose(m.covariance, np.cov(own.T, bias=True))


def test_calibration_finds_the_curve():
    odds = np.arange(801) * 0.1 - 40
    chance = 1 / (1 + np.exp(-(0.5 * odds - 1)))
    counts = np.stack([1000 * (1 - chance), 1000 * chance])
    _, slope, shift = quality._calibrated(counts)
    assert slope == pytest.approx(0.5, abs=0.01) and shift == pytest.approx(-1, abs=0.02)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    found = quality.query(spark, FOLDER).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in found if r.quality == 1]
    bad = [r.score for r in found if r.quality == 0]
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.97
    right = sum(r.predicted == r.quality for r in found) / len(found)
    assert right > 0.95


def test_labels_of_the_held_out_rows_do_not_count(spark, edge_docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = quality.with_statistics(docs).select("doc_id", "statistics")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [quality.fit(rows, x.where(~quality.held_out())) for x in (labels, turned)]
    scores = [{r.doc_id: r.quality for r in m.score(rows).collect()} for m in models]
    assert scores[0].keys() == scores[1].keys()
    assert all(abs(v - scores[1][k]) < 1e-6 for k, v in scores[0].items())
    # Every row gets a score, edge rows too, and other columns stay.
    edge = models[0].score(quality.with_statistics(edge_docs.withColumn("quality", F.lit("x"))))
    assert set(edge_docs.columns) < set(edge.columns)
    values = [r.quality for r in edge.collect()]
    assert len(values) == edge_docs.count() and all(0 <= v <= 1 for v in values)


def test_without_labels_of_both_kinds(spark, no_docs):
    docs = documents(spark, [(i, f"text {i}", "a") for i in range(30)])
    rows = quality.with_statistics(docs)

    def scores(labelled, of=rows):
        labels = spark.createDataFrame(labelled, "doc_id long, quality int")
        return {r.quality for r in quality.fit(of, labels).score(of).collect()}

    assert scores([]) == {0.0}
    assert scores([(i, 1) for i in range(30)]) == {1.0}
    assert scores([(None, 1), (1, None)]) == {0.0}
    assert scores([(1, 1), (2, 0), (2, 0), (1, 0)]) == {0.5}
    assert scores([(1, 1)], quality.with_statistics(no_docs)) == set()
