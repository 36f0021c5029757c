"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from weft.llm import trie
from weft.llm.common import stored

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # names that the operator could have wanted for itself
    T.StructField("n", T.StringType()), T.StructField("d", T.StringType()), T.StructField("prefix", T.StringType()), T.StructField("a.b", T.StringType()),
])


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda r: hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()
    for c in own:
        own[c] = [(r[2], r[3]) for r in sorted(own[c], key=lambda r: (r[0], r[1], digest(r)))]
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        worth = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += worth
    out = Counter()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(node))
        out[min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def table(spark, rows):
    return stored(spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(3), "test-conversations")


def found(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


ODD = [
    (0, 0, "user", "hi"), (0, 1, None, "there"), (0, 2, "user", None), (0, None, "system", "first"), (0, None, "system", "also first"), (0, 1, None, "there"),
    (-3, 1, "user", "é" * 300), (-3, 2, "a", ""), (7, 0, "user", "hi"), (7, 0, "user", "hi"), (8, 5, "user", "x" * 100_000), (None, 0, "user", "lost"),
    (11, 0, "u", "only"), (13, 0, "u", "none borrowed"),
]


def random_rows(seed, n, longest=9, words=3):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-40, 400), n):
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice("abcdefgh"[:words]) * rng.randint(1, 2)) for t in range(rng.randint(1, longest))]
    return rows


def test_odd_rows(spark):
    assert found(trie.prefix_trie(table(spark, ODD))) == brute(ODD)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_and_mates(spark, monkeypatch, seed):
    """Many ranges, few segments left to one task, pieces of few ids: all ways through the ranking are taken."""
    monkeypatch.setattr(trie, "IDS_PER_PIECE", 3)
    rows = random_rows(seed, 150, words=2) + ODD
    assert found(trie.prefix_trie(table(spark, rows), nodes_per_task=40, few=5)) == brute(rows)


def test_long_and_copied_conversations(spark):
    """Blocks of blocks of turns, and a family of copies of which one goes on."""
    long = [(t, "user", f"turn {t}") for t in range(90)]
    rows = [(c, *t) for c in range(1000, 1060, 5) for t in long[: 90 - c % 3]] + [(5, t, "user", "same") for t in range(70)] + ODD
    assert found(trie.prefix_trie(table(spark, rows), block=4, nodes_per_task=100, few=10)) == brute(rows)


def test_a_node_with_most_children(spark):
    rows = [r for c in range(0, 2000, 5) for r in ((c, 0, "system", "the same for all"), (c, 1, "user", f"my own {c}"))]
    assert found(trie.prefix_trie(table(spark, rows), nodes_per_task=50, few=20)) == brute(rows)


def test_hot_conversation_is_numbered_in_slices(spark, monkeypatch):
    monkeypatch.setattr("weft.operators.sequences.HOT_ROWS", 50)
    monkeypatch.setattr(trie, "SLICE", 16)
    rows = [(10, t, "user", f"{t % 7}") for t in range(300)] + [(11, t, "user", f"{t % 7}") for t in range(120)] + ODD
    assert found(trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_empty(spark):
    assert trie.prefix_trie(table(spark, [])).count() == 0
    assert trie.prefix_trie(table(spark, [(None, 1, "a", "b")])).count() == 0
