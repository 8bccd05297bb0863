"""The prefix trie and subtree sums against plain Python."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from ledgerline.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, parent string, depth long, words string"


def _turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", -1, "z") for r in rows], SCHEMA)


def _plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(turns)] for c, turns in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        block = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built = tuple(convs.get(block, [])[:h] + own[h:])
        for d in range(len(built) + 1):
            members.setdefault(built[:d], []).append(c)
        ends.setdefault(built, []).append(c)
    found = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in members if len(n) == len(node) + 1 and n[:-1] == node]
        leaves = [n for n in below if not any(m[:-1] == n and m for m in members)]

        def words(n):
            return len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0

        text = ",".join(map(str, sorted(ends.get(node, []))))
        found.append(
            (
                min(own),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(own),
                len(children),
                len(leaves),
                sum((len(members[n]) - 1) * words(n) for n in below),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def _found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _random_turns(seed, convs):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 200), convs):
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "b c", "d  e\nf"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = _random_turns(seed, 90)
    assert _found(trie.prefix_trie(_turns(spark, rows))) == _plain(rows)


def test_edge_rows(spark):
    long = "word " * 50_000
    rows = [
        (None, 0, "user", "no conversation"),
        (0, None, None, None),
        (0, None, "user", "tie b"),
        (0, None, "user", "tie a"),
        (0, 5, "user", "same"),
        (0, 5, "user", "same"),
        (1, 0, "user", long),
        (2, 0, "", ""),
        (3, 7, None, "x"),
        (3, -7, None, " \t\n"),
        # Their blocks have no first conversation, and they may end up without a turn.
        *((c, 0, "user", "alone") for c in (41, 42, 43, 44, 45, 46)),
        (2**63 - 1, 0, "user", "last"),
        (-(2**63), 0, "user", "first"),
    ]
    assert _found(trie.prefix_trie(_turns(spark, rows))) == _plain(rows)


def test_no_turns_no_nodes(spark):
    assert _found(trie.prefix_trie(_turns(spark, []))) == []
    assert _found(trie.prefix_trie(_turns(spark, [(None, 1, "a", "b")]))) == []


def test_long_conversations_are_ordered_in_buckets(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(trie, "BUCKET", 4)
    rows = [(7, t, "user", f"turn {t % 3}") for t in range(60)]
    rows += [(20, t, "user", f"turn {t % 3}") for t in range(30)] + _random_turns(3, 20)
    rows = list(dict.fromkeys(rows))
    assert _found(trie.prefix_trie(_turns(spark, rows))) == _plain(rows)


def _plain_sums(nodes):
    parents = {i: p for i, p, *_ in nodes}
    sums = {i: [0, 0] for i in parents}
    for i, _, *values in nodes:
        at = i
        while at in sums:
            sums[at] = [a + b for a, b in zip(sums[at], values, strict=True)]
            at = parents[at]
    return sorted((i, *v) for i, v in sums.items())


@pytest.mark.parametrize("shape", ["chain", "star", "forest", "caterpillar"])
def test_subtree_sums_of_any_tree(spark, shape, monkeypatch):
    rng = random.Random(shape)
    parent = {
        "chain": lambda i: i - 1 if i else None,
        "star": lambda i: 0 if i else None,
        "forest": lambda i: rng.choice([None, -5, rng.randrange(i)]) if i else None,
        "caterpillar": lambda i: (i - 1 if i % 2 else max(0, i - 2)) if i else None,
    }[shape]
    nodes = [(i, parent(i), rng.randrange(100), -i) for i in range(90)]
    rng.shuffle(nodes)
    rounds = []
    made = trie._without_leaves
    monkeypatch.setattr(trie, "_without_leaves", lambda *a: rounds.append(1) or made(*a))
    df = spark.createDataFrame(nodes, "id long, parent long, a long, b long")
    assert _found(trie.subtree_sums(df, ["a", "b"])) == sorted(_plain_sums(nodes), key=repr)
    # 90 in a row would need as many rounds without compressing.
    assert len(rounds) < 25


def test_a_cycle_is_refused(spark):
    df = spark.createDataFrame([(1, 2, 0), (2, 1, 0), (3, 1, 0)], "id long, parent long, a long")
    with pytest.raises(ValueError, match="ancestors"):
        trie.subtree_sums(df, ["a"])


def test_ids_of_one_node_are_joined_over_many_ranges(spark, conf):
    rows = [(1, 2, i * 7 - 900) for i in range(700)] + [(1, 3, 5), (-4, 2, 6)]
    with conf(spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = trie.digests(spark.createDataFrame(rows, "k1 long, k2 long, conv_id long").repartition(5), ["k1", "k2"])
        text = ",".join(str(i * 7 - 900) for i in range(700))
        assert {(r.k1, r.k2): r.digest for r in found.collect()} == {
            (1, 2): hashlib.sha256(text.encode()).hexdigest(),
            (1, 3): hashlib.sha256(b"5").hexdigest(),
            (-4, 2): hashlib.sha256(b"6").hexdigest(),
        }


def test_sql_gives_the_rows(spark):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    wanted = sorted(duck.sql(trie.SQL).fetchall(), key=repr)
    assert _found(trie.query(spark, folder)) == wanted and wanted
