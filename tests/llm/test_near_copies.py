"""SimHash groups, components and repeated bytes against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash, suffix_dedup
from ledgerline.llm.components import connected_components
from tests.llm.conftest import documents, random_rows


def _plain_print(text, width=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_groups(values, linked):
    """The smallest position that each position can reach."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints_and_groups_equal_brute_force(spark):
    rows = random_rows(3, 250, words=30)
    ids = [i for i, _, _ in rows]
    prints = [_plain_print(t) for _, t, _ in rows]
    groups = _plain_groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    found = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    for i, value, group in zip(ids, prints, groups, strict=True):
        assert found[i].fingerprint == f"{value:016x}"
        assert found[i].component_id == ids[group]
        assert found[i].keep == (ids[group] == i)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_links_connect_what_brute_force_links(spark, bits):
    rng = random.Random(bits)
    values = {rng.getrandbits(64) for _ in range(40)}
    for value in list(values)[:12]:
        for _ in range(20):
            values.add(value ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    # A large bucket of prints that chain together.
    chain = rng.getrandbits(64)
    for _ in range(300):
        chain ^= 1 << rng.randrange(20)
        values.add(chain)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    links = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, bits).collect()}
    assert all(0 < (a ^ b).bit_count() <= bits for a, b in links)
    wanted = _plain_groups(values, lambda a, b: (a ^ b).bit_count() <= bits)
    place = {v: i for i, v in enumerate(values)}
    pairs = {(place[a], place[b]) for a, b in links}
    got = _plain_groups(range(len(values)), lambda i, j: (i, j) in pairs or (j, i) in pairs)
    assert got == wanted
    assert len(links) < 40 * len(values)


def test_segments_are_the_fewest_that_leave_one_bit():
    for bits in range(9):
        masks = simhash.segments(bits)
        assert sum(masks) == (1 << 64) - 1
        assert bits // len(masks) <= 1 and (len(masks) == 1 or bits // (len(masks) - 1) > 1)


def test_near_duplicates_on_edge_rows(edge_docs, no_docs):
    assert simhash.near_duplicates(no_docs).isEmpty()
    found = simhash.near_duplicates(edge_docs).collect()
    assert len(found) == edge_docs.count()
    empty = [r for r in found if int(r.fingerprint, 16) == 0]
    # Null, empty and blank texts are one group, whose smallest id is 1.
    assert {r.component_id for r in empty} == {1} and len(empty) == 5
    kept = Counter((r.component_id, r.doc_id) for r in found if r.keep)
    # Two equal rows, and another text of the same doc_id in a group of its own.
    assert kept[(4, 4)] == 3
    assert set(kept) >= {(1, 1), (5, 5), (7, 7), (None, None)}


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    edges += [(200, 200), (301, 300), (300, 301)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in connected_components(frame).collect() if r.node != r.root}
    assert found == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 160)} | {301: 300}


def _plain_repeats(rows):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            key = data[p : p + 50]
            first[key] = min(first.get(key, i), i)
    result = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < i:
                gone[p : p + 50] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        result.append((i, len(data), int(gone.sum()), spans, kept))
    return Counter(result)


@pytest.mark.parametrize("sizes", [(8 << 20, 12 << 20, 4096), (3_000, 5_000, 4096), (1_000, 9_000, 3)])
def test_repeated_bytes_equal_brute_force(spark, edge_docs, no_docs, monkeypatch, sizes):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", sizes[0])
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", sizes[1])
    monkeypatch.setattr(suffix_dedup, "FAN", sizes[2])
    rng = random.Random(9)
    passages = ["".join(rng.choices("abc é\n", k=rng.randint(45, 130))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 60))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages)[rng.randrange(30) :])
        rows.append((rng.randrange(100), "".join(parts), "a"))
    rows += [(500 + i, "a" * n, "a") for i, n in enumerate((49, 50, 51, 200, 400))]
    rows += [(600, "\0" * 80, "a"), (601, "\0" * 90 + "x", "b")]
    found = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    plain = _plain_repeats([(i, t) for i, t, _ in rows])
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == plain
    if sizes[0] > 10_000:
        assert suffix_dedup.remove_repeats(no_docs).isEmpty()
        edge = suffix_dedup.remove_repeats(edge_docs).collect()
        assert len(edge) == edge_docs.count()
        assert all(r.n_bytes == r.n_removed + len(r.kept) for r in edge)


def test_no_place_sees_more_lists_than_the_fan(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FAN", 4)
    lists = spark.range(100).selectExpr("id AS gid", "0L AS part", "1L AS many")

    def few(table):
        assert table.num_rows <= 4
        return table

    def up(table):
        many = sum(few(table).column("many").to_pylist())
        return pa.table({"gid": table.column("block")[:1], "part": [0], "many": [many]})

    def top(table):
        many = sum(few(table).column("many").to_pylist())
        return pa.table({"gid": table.column("gid"), "part": [0] * table.num_rows, "many": [many] * table.num_rows})

    def down(table, answer):
        assert answer.num_rows == 1
        again = answer.column("many").to_pylist() * few(table).num_rows
        return pa.table({"gid": table.column("gid"), "part": [0] * table.num_rows, "many": again})

    kinds = "gid long, part long, many long"
    found = suffix_dedup._of_parts(lists, 100, 1, up, top, down, kinds, kinds).collect()
    assert sorted((r.gid, r.many) for r in found) == [(i, 100) for i in range(100)]


def test_repeats_without_doc_ids_and_with_other_ids(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 500)
    line = "a line that is longer than fifty bytes, and that stands in all documents"
    rows = [(None, f"{i} {line}", "a") for i in range(40)] + [(5, line, "a"), (6, line, None)]
    found = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    removed = Counter((r.doc_id, r.n_removed) for r in found)
    # A missing doc_id is the smallest: what has none keeps all.
    assert removed == {(None, 0): 40, (5, len(line)): 1, (6, len(line)): 1}
    with pytest.raises(TypeError, match="integral"):
        suffix_dedup.remove_repeats(documents(spark, rows).withColumn("doc_id", F.lit("x")))


def test_merge_of_runs_sorts_and_tells_common_prefixes():
    rng = random.Random(4)
    width = suffix_dedup.KEY
    keys = [bytes(rng.choices((0, 1, 255), k=3)) + bytes(width - 3) for _ in range(90)]
    keys += [bytes(rng.choices(range(2), k=width)) for _ in range(60)]
    for number in (1, 2, 3, 7):
        runs = [sorted(set(keys[i::number])) for i in range(number)]

        def coded(run):
            before = None
            for key in run:
                same = 0
                while before is not None and same < width and key[same] == before[same]:
                    same += 1
                yield same, key
                before = key

        out = list(suffix_dedup.merge_runs([coded(run) for run in runs]))
        assert [key for _, _, key in out] == sorted(k for run in runs for k in run)
        for (_, _, a), (_, same, b) in zip(out, out[1:], strict=False):
            assert a[:same] == b[:same] and (same == width or a[same] != b[same])
