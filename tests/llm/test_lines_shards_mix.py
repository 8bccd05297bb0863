"""Line dedup, sharding and mixing against plain Python, on edge rows and test data."""

import time
import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import line_dedup, mixing, sharding
from tests.llm.conftest import SF, documents, random_rows

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BLANKS = " \t\n\x0b\f\r"


def _key(line):
    return line.strip(BLANKS).translate(LOWER)


def _plain_line_dedup(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(_key(line)) >= min_chars:
                holders[_key(line)].add(i)
    shared = {
        k: max((i for i in ids if i is not None), default=None)
        for k, ids in holders.items()
        if len(ids) >= min_docs
    }
    result = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if _key(x) not in shared or shared[_key(x)] == i]
        result.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(result)


@pytest.mark.parametrize("limits", [(40, 5), (1, 2)])
def test_line_dedup_equals_plain(edge_docs, small, limits):
    for docs in (edge_docs, small):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        found = line_dedup.drop_shared_lines(docs, *limits).collect()
        assert Counter(map(tuple, found)) == _plain_line_dedup(rows, *limits)


def test_line_dedup_of_nothing(no_docs):
    assert line_dedup.drop_shared_lines(no_docs).isEmpty()


def _check_shards(rows, out, shards):
    """Equal counts, gapless slots and, in every shard, the mixture of the whole."""
    assert len(out) == len(rows)
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    for source, n in Counter(s for _, _, s in rows).items():
        for s in range(shards):
            own = sum(r.source == source and r.shard == s for r in out)
            # Ranks of a source are evenly spread, and other sources shift a cut a little.
            assert abs(own - n / shards) <= 3


def test_interleaving_keeps_counts_and_mixture(spark, edge_docs, no_docs):
    assert sharding.interleave(no_docs).isEmpty()
    for rows in (random_rows(5, 200), [(i, "t", f"s{i}") for i in range(50)]):
        docs = documents(spark, rows)
        out = sharding.interleave(docs, shards=4).collect()
        if len({s for _, _, s in rows}) < 5:
            _check_shards(rows, out, 4)
        again = sharding.interleave(docs.repartition(7), shards=4)
        assert {(r.doc_id, r.shard, r.slot) for r in out} == {
            (r.doc_id, r.shard, r.slot) for r in again.collect()
        }
    out = sharding.interleave(edge_docs, shards=3).collect()
    assert len(out) == edge_docs.count()
    assert Counter(Counter(r.shard for r in out).values())
    assert all(isinstance(r.shard, int) and r.row == "x" for r in out)


def test_interleaving_equals_a_plain_sort(spark):
    rows = random_rows(8, 150)
    out = sharding.interleave(documents(spark, rows), shards=7, seed=3).collect()
    strata = defaultdict(list)
    for i, text, source in rows:
        key = hashlib.md5(f"3:{i}".encode()).hexdigest()
        strata[source].append((key, zlib.crc32(text.encode()), i))
    places = []
    for source, own in strata.items():
        u = int(hashlib.md5((source or "").encode()).hexdigest()[:8], 16) / 2.0**32
        for rank, (key, tie, i) in enumerate(sorted(own)):
            places.append(((rank + 1 - u) / len(own), source is None, source or "", key, tie, i))
    places.sort()
    n = len(places)
    expected = {}
    for place, row in enumerate(places):
        shard = place * 7 // n
        expected[row[-1]] = (shard, place - -(-shard * n // 7))
    assert {r.doc_id: (r.shard, r.slot) for r in out} == expected


def test_sharding_query_and_files(spark, tmp_path):
    out = sharding.query(spark, SF)
    assert {r.law for r in out.collect()} == {"rows"}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sharding.write_shards(sharding.interleave(docs, shards=3), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 3


def test_rows_without_doc_id_are_dealt_out_in_the_order_of_a_plain_sort(spark):
    rows = [(None if i % 3 else i, "w " * (i % 200) + str(i % 450), "a") for i in range(900)]
    docs = documents(spark, rows).withColumn("size", mixing.word_count("text"))
    for seed, tie, step in (
        (7, F.crc32("text"), lambda c: F.shiftright(c, 20)),
        (11, F.col("size"), lambda c: F.floor(F.log1p(c) * 64)),
    ):
        keyed = docs.select(sharding.shuffle_key(seed).alias("key"), tie.alias("tie"))
        keyed = keyed.withColumn("bucket", sharding.shuffle_bucket(seed, step(F.col("tie"))))
        found = sorted((r.bucket, r.key, r.tie) for r in keyed.collect())
        assert [r[1:] for r in found] == sorted(r[1:] for r in found)
        none = Counter(r[0] for r in found if r[1] == hashlib.md5(f"{seed}:".encode()).hexdigest())
        assert sum(none.values()) == 600 and max(none.values()) <= 100
    out = sharding.interleave(docs, shards=9, seed=3).collect()
    _check_shards(rows, out, 9)


def test_sources_are_weighed_by_place_in_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = [f"s{i:03}" for i in range(300)] + [""]
        sources = spark.createDataFrame([(n is None, n or "", 1) for n in [*names, None]], "no_source boolean, source_name string, source_size long")
        found = {(r.no_source, r.source_name): r.weight for r in mixing.cyclic_weights(sources.repartition(4)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {k: (3.0, 1.0, 2.0)[i % 3] for i, k in enumerate(sorted(found))} and len(found) == 302


def _plain_fill(weights, caps, total):
    target, clamped = {}, set()
    while True:
        free = sum(w for s, w in weights.items() if s not in clamped)
        left = total - sum(caps[s] for s in clamped)
        target = {s: caps[s] if s in clamped else left * w / free for s, w in weights.items() if s in clamped or free}
        new = {s for s in target if s not in clamped and target[s] >= caps[s]}
        if not new:
            return target
        clamped |= new


def test_mix_equals_plain(spark):
    rows = random_rows(13, 180) + [(1000 + i, "w " * 40, "c") for i in range(30)]
    rows += [(2000, "", "d"), (2001, None, "d"), (2002, "w " * 500, "e")]
    docs = documents(spark, rows).withColumn("size", mixing.word_count("text"))
    out = mixing.mix(docs, "size").collect()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    size = defaultdict(int)
    for i, _, s in rows:
        size[s] += words[i]
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weights = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(names)}
    target = _plain_fill(weights, {s: 2.0 * size[s] for s in names}, 1.5 * sum(size.values()))
    taken = Counter()
    for r in out:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * words[r.doc_id]
    for s in names:
        largest = max(words[i] for i, _, t in rows if t == s)
        assert abs(taken[s] - target[s]) <= largest / 2 + 1e-6


def test_mix_edge_rows(edge_docs, no_docs):
    assert mixing.mix(no_docs.withColumn("n", mixing.word_count("text")), "n").isEmpty()
    sized = edge_docs.withColumn("n", mixing.word_count("text"))
    out = mixing.mix(sized, "n").collect()
    assert len(out) == edge_docs.count()
    again = mixing.mix(sized.repartition(5), "n").collect()
    assert Counter((r.doc_id, r.copies) for r in out) == Counter((r.doc_id, r.copies) for r in again)


def test_water_filling_with_too_little_room_and_without_weights(spark):
    table = spark.createDataFrame(
        [("a", 1.0, 10.0), ("b", 2.0, 5.0), ("c", 0.0, 5.0), ("d", None, 5.0)],
        "name string, weight double, cap double",
    )
    found = {r.name: r.target for r in mixing.water_fill(table, 100.0).collect()}
    assert found == {"a": 10.0, "b": 5.0, "c": 0.0, "d": 0.0}
    found = {r.name: r.target for r in mixing.water_fill(table, 12.0).collect()}
    assert found == {"a": 7.0, "b": 5.0, "c": 0.0, "d": 0.0}


def test_many_dropped_lines_of_one_text_take_no_square(spark):
    lines = [f"A line that stands in a good number of documents, number {i}" for i in range(80_000)]
    rows = [(i, "\n".join([f"own {i}", *lines]), "a") for i in range(5)]
    start = time.time()
    found = {r.doc_id: r for r in line_dedup.drop_shared_lines(documents(spark, rows)).collect()}
    assert time.time() - start < 45
    assert [found[i].n_dropped for i in range(5)] == [80_000] * 4 + [0]
    assert [found[i].kept for i in range(4)] == [f"own {i}" for i in range(4)]
    assert found[4].kept == rows[4][1]
