"""The probabilistic suffix tree against a plain one in memory, and on held-out text."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weft.llm import suffix_tree
from weft.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, learns, least_share, longest, least_gain, smoothing):
    texts = [(i, learns(i), re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["\n"]) for i, t in rows]
    after = defaultdict(Counter)  # next words of every context of up to ``longest`` words
    for _, yes, w in texts:
        for at in range(len(w)) if yes else ():
            for d in range(min(longest, at) + 1):
                after[tuple(w[at - d : at])][w[at]] += 1
    total, types = sum(after[()].values()), len(after[()])
    least = max(2, math.ceil(least_share * total))
    candidates = {s for s, c in after.items() if s and sum(c.values()) >= least}

    def p(w, s):
        if not s:
            return (after[()][w] + 1) / (total + types + 1)
        return (after[s][w] + smoothing * p(w, s[1:])) / (sum(after[s].values()) + smoothing)

    def gain(s):
        n = sum(after[s].values())
        return sum(c * math.log((c - 1 + smoothing * p(w, s[1:])) / (n - 1 + smoothing) / p(w, s[1:])) for w, c in after[s].items())

    kept = {()}
    for s in candidates:
        if gain(s) >= least_gain:
            kept |= {s[i:] for i in range(len(s))}
    out = []
    for i, yes, w in texts:
        score = 0.0
        for at in range(len(w)):
            d = max(d for d in range(min(longest, at) + 1) if tuple(w[at - d : at]) in kept)
            score += math.log10(p(w[at], tuple(w[at - d : at])))
        out.append((i, yes, len(w), sum(after[()][x] > 0 for x in w), total, sum(math.log10(p(x, ())) for x in w), score))
    return out, kept


def rows_of(df):
    return [(r["doc_id"], r["learned"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in df.collect()]


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[3], round(r[5], 6), round(r[6], 6))
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def chain(seed, n_docs):
    """Texts in which the next word mostly depends on one or two words before it."""
    rng, docs = random.Random(seed), []
    for i in range(n_docs):
        w = ["a", "b"]
        for _ in range(rng.randint(0, 40)):
            x = rng.random()
            w.append(
                "q" if w[-3:] == ["c", "a", "b"] and x < 0.9 else "z" if w[-2:] == ["a", "b"] and x < 0.7 else "b" if w[-1] == "a" and x < 0.7
                else "A" if w[-1] == "c" and x < 0.4 else rng.choice("aabbbbcccde") if x < 0.95 else f"rare{rng.randint(0, 300)}"
            )
            w[-1] = w[-1].lower()
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(x.upper() if rng.random() < 0.2 else x for x in w)))
    return docs


ODD = [(500, None), (501, ""), (502, " \n "), (None, "a b z"), (503, "a b z"), (503, "a b z"), (504, "Éa éA unheard ünheard"), (505, "a b " * 30_000)]
YES = lambda i: i is None or i % 4 != 1
LEARNS = "doc_id IS NULL OR doc_id % 4 <> 1"


@pytest.mark.parametrize("batch_bytes", [32 << 20, 300])
def test_against_brute_force(make_docs, monkeypatch, batch_bytes):
    monkeypatch.setattr(suffix_tree, "BATCH_BYTES", batch_bytes)
    rows = chain(3, 300) + ODD
    want, kept = brute(rows, YES, 0.002, 3, 4.0, 5.0)
    assert {len(s) for s in kept} == {0, 1, 2, 3}
    same(rows_of(suffix_tree.score(make_docs(rows), F.expr(LEARNS), 0.002, 3, 4.0, 5.0)), want)


def test_nothing_to_learn_from(make_docs):
    want, _ = brute(ODD, lambda i: False, 0.01, 2, 1.0, 5.0)
    same(rows_of(suffix_tree.score(make_docs(ODD), F.lit(False), 0.01, 2, 1.0, 5.0)), want)
    assert suffix_tree.score(make_docs([]), F.expr(LEARNS)).count() == 0


def test_learnt_contexts_help_on_held_out_text(make_docs):
    got = [r for r in rows_of(suffix_tree.score(make_docs(chain(5, 400)), F.expr(LEARNS), 0.001, 3, 10.0, 10.0)) if not r[1]]
    assert sum(r[6] for r in got) > 0.9 * sum(r[5] for r in got)  # log probabilities are negative


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, kept = brute(docs, lambda i: zlib.crc32(str(i).encode()) % 7 != 2, 1e-4, 3, 20.0, 50.0)
    got = QUERIES["op11_suffix_tree_scores"](spark, sf)
    same(rows_of(got.withColumn("learned", ~F.col("held_out"))), want)
    assert len(kept) > 20
