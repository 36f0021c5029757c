"""Near-duplicate groups against brute force, and the statistics of the registers."""

import random
from collections import Counter

import numpy as np
import pytest

from weft.llm import near_dedup
from weft.llm.common import stored


def brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), (True, 0)), (doc_id is None, doc_id or 0))
    return Counter((doc_id, len(sets[i]), None if least[find(i)][0] else least[find(i)][1]) for i, (doc_id, _) in enumerate(rows))


def edited(rng, words, share):
    return [rng.choice(["new", "word", "x"]) + str(rng.random()) if rng.random() < share else w for w in words]


@pytest.mark.parametrize("n, percent, pivots", [(3, 85, 8), (5, 80, 1)])
def test_near_duplicates(make_docs, monkeypatch, n, percent, pivots):
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
    rng = random.Random(n)
    words = lambda k: [f"w{rng.randint(0, 3000)}" for _ in range(k)]
    rows = []
    for _ in range(6):
        base = words(150)
        rows += [(None, " ".join(edited(rng, base, rng.choice([0, 0.005, 0.02, 0.05, 0.08])))) for _ in range(30)]
    chain = words(200)  # each close to the one before, the ends far apart
    for _ in range(12):
        rows.append((None, " ".join(chain)))
        chain = chain[3:] + words(3)
    rows += [(None, " ".join(words(rng.randint(1, 60)))) for _ in range(60)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    rows = [(i, t) for i, (_, t) in zip(ids, rows)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "one two"), (906, rows[0][1].upper()), (906, rows[0][1].upper()), (None, "a b c d e f"), (None, "a b c d e f"), (907, "z " * 5000)]
    got = near_dedup.near_duplicates(make_docs(rows), n, percent).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, n, percent)
    groups = Counter(r["component_id"] for r in got if r["kept"])
    assert set(groups) == {r["component_id"] for r in got}
    assert all(r["doc_id"] == r["component_id"] for r in got if r["kept"])


@pytest.mark.parametrize("pivots", [1, 8])
def test_a_family_edited_at_the_same_places(make_docs, monkeypatch, pivots):
    """Edits are shared by some members, so few shingles are a member's own, and many pairs lie about the threshold."""
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
    rng = random.Random(12)
    base = [f"w{rng.randint(0, 900)}" for _ in range(160)]
    rows = []
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(0, 160, 4), rng.choice([1, 2, 3, 4, 5, 6, 8])):
            words[at] = f"edit{at}-{rng.randint(0, 2)}"
        rows.append((i, " ".join(words)))
    got = near_dedup.near_duplicates(make_docs(rows), 3, 85).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, 3, 85)
    assert 5 < sum(r["kept"] for r in got) < 155


def test_nothing_to_link(make_docs):
    assert near_dedup.near_duplicates(make_docs([])).count() == 0
    got = near_dedup.near_duplicates(make_docs([(1, None), (2, ""), (3, "alone")])).collect()
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in got) and len(got) == 3
    docs = make_docs([(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, "h")])
    kept = near_dedup.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and kept.columns == docs.columns


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(1)
    for similarity, pruned in ((0.3, (0.99, 1)), (0.85, (0, 0)), (0.95, (0, 0))):
        n, pairs = 400, []
        both = round(2 * n * similarity / (1 + similarity))
        for _ in range(150):
            pool = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
            pairs.append((pool[:n], pool[n - both : 2 * n - both]))
        a, b = (near_dedup.registers([p[i] for p in pairs]) for i in range(2))
        assert abs((a == b).mean() - similarity) < 0.02
        union = near_dedup.registers([np.union1d(*p) for p in pairs])
        assert (union == np.maximum(a, b)).all()
        sizes = np.full(150, float(n))
        assert pruned[0] <= near_dedup.unlikely(a, b, sizes, sizes, 0.85).mean() <= pruned[1]


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(rng.randint(500, 700), rng.randint(500, 700)) for _ in range(120)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in near_dedup.components(stored(spark.createDataFrame(edges, "a long, b long"), "test-edges")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
