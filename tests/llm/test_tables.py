"""Exact dedup, line dedup, mixing, sharding and top-k against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm import exact_dedup, line_dedup, mixing, sharding, topk
from weft.llm.common import stored

ROWS = [
    (5, "same  text"), (3, "same\ttext"), (9, "same text "), (4, "other"), (4, "other"), (None, "other"), (7, None), (8, ""),
    (None, "alone"), (1, "x" * 200_000), (2, "x" * 200_000),
]


def test_exact_dedup(make_docs):
    index = exact_dedup.DigestIndex(make_docs([]).sparkSession, buckets=4)
    got = index.ingest(make_docs(ROWS)).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_digest_index_persists(spark, make_docs):
    first = exact_dedup.DigestIndex(spark, buckets=4)
    first.ingest(make_docs(ROWS)).count()
    spark.sql(f"DROP TABLE {first.name}")  # as in a new session
    again = exact_dedup.DigestIndex(spark, first.path, buckets=4)
    got = {r["doc_id"]: r for r in again.ingest(make_docs([(50, "same text"), (51, "new"), (52, "new")])).collect()}
    assert (got[50]["kept"], got[50]["keep_id"]) == (False, 3)
    assert (got[51]["kept"], got[52]["kept"], got[52]["keep_id"]) == (True, False, 51)
    assert again.entries().count() == 7  # six texts of the first batch, one of the second


def test_exact_dedup_empty(spark, make_docs):
    assert exact_dedup.DigestIndex(spark).ingest(make_docs([])).count() == 0
    assert exact_dedup.keep_first(make_docs(ROWS)).count() == 6


def line_brute(rows, counted, min_docs):
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in (t or "").split("\n")]
    docs = Counter(k for _, t in counted for k in set(keys(t)))
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys(t)) if not k or docs[k] < min_docs]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_line_dedup_is_reversible(spark, make_docs):
    rng = random.Random(2)
    common = [f"Line {i} Éa" for i in range(40)]
    text = lambda: "\n".join(rng.choice([rng.choice(common), f" {rng.choice(common).upper()}\t", str(rng.random()), "", "  "]) for _ in range(rng.randint(1, 9)))
    first = [(i, text()) for i in range(60)] + [(60, None), (61, ""), (62, "\n\n"), (62, "\n\n"), (None, common[0]), (63, common[1] + "\n" + common[1])]
    second = [(100 + i, text()) for i in range(30)]
    index = line_dedup.LineIndex(spark, min_docs=3, shards=2)
    a, b = make_docs(first), make_docs(second)
    rows = lambda df: Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect())
    index.insert(a)
    before = line_brute(first, first, 3)
    assert rows(index.clean(a)) == before and sum(x[2] for x in before) > 20
    counts = sorted(index.counts().collect())
    index.insert(b)
    assert rows(index.clean(a)) == line_brute(first, first + second, 3)
    index.delete(b)
    assert sorted(index.counts().collect()) == counts
    assert rows(index.clean(a)) == before
    keys = {r["shard"]: r["n_keys"] for r in index.filters.collect()}
    assert sum(keys.values()) == sum(c["n"] >= 3 for c in counts)
    assert index.clean(make_docs([])).count() == 0


def test_line_index_is_opened_again_and_grows(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 4)
    first = [(i, "\n".join(f"line {j}" for j in range(i % 7))) for i in range(30)]
    second = [(100 + i, "\n".join(f"more {j}" for j in range(40))) for i in range(5)]
    a, b = make_docs(first), make_docs(second)
    rows = lambda df: Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect())
    index = line_dedup.LineIndex(spark, f"{tmp_path}/index", min_docs=3, shards=1)
    index.insert(a)
    assert index.shards == 1
    again = line_dedup.LineIndex(spark, f"{tmp_path}/index", min_docs=3, shards=1)
    assert rows(again.clean(a)) == rows(index.clean(a)) == line_brute(first, first, 3)
    again.insert(b)
    assert again.shards > 1 and again.version == 2
    both = line_brute(first, first + second, 3)
    assert rows(again.clean(a)) == both and rows(line_dedup.LineIndex(spark, f"{tmp_path}/index", min_docs=3, shards=1).clean(a)) == both
    again.delete(b)
    assert rows(again.clean(a)) == line_brute(first, first, 3)


def test_line_dedup_of_a_very_long_text(spark, make_docs):
    rows = [(1, "same\n" * 200_000 + "own"), (2, "same"), (3, "x" * 2_000_000)]
    index = line_dedup.LineIndex(spark, min_docs=2)
    docs = make_docs(rows)
    index.insert(docs)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in index.clean(docs).collect()}
    assert got == {1: (200_001, 200_000, "own"), 2: (1, 1, ""), 3: (1, 0, "x" * 2_000_000)}


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys, others = rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2), rng.integers(0, 2**63, 20000).astype(np.uint64)
    cuckoo = line_dedup.CuckooFilter.sized(5000)
    assert cuckoo.add(keys)
    assert cuckoo.contains(keys).all() and cuckoo.contains(others).mean() < 0.01
    cuckoo.remove(keys[:2500])
    assert cuckoo.contains(keys[2500:]).all() and cuckoo.contains(keys[:2500]).mean() < 0.01
    cuckoo.remove(keys[2500:])
    assert not cuckoo.table.any()
    assert not line_dedup.CuckooFilter(2).add(keys[:100])  # too small, and says so


def test_mixing(make_docs):
    rows = [(i, "t", "en", "big" if i < 4000 else "small" if i < 4100 else None, 1) for i in range(4300)]
    docs = make_docs(rows)
    got = mixing.replicate(docs, {"big": 0.5, "absent": 0.2}, ratio=1.5)
    by = Counter(r["source"] for r in got.select("source").collect())
    # the named source without rows is left out: big has 0.5 of 0.8, the others divide 0.3
    for source, share in (("big", 0.5 / 0.8), ("small", 0.15 / 0.8), (None, 0.15 / 0.8)):
        mean = 1.5 * 4300 * share
        assert abs(by[source] - mean) < 5 * math.sqrt(mean), (source, by)
    assert got.columns[: len(docs.columns)] == docs.columns
    same = lambda df: Counter((r["doc_id"], r["weft_copy"], r["weft_copies"]) for r in df.collect())
    assert same(got) == same(mixing.replicate(docs, {"big": 0.5, "absent": 0.2}, ratio=1.5))
    assert set(same(got).values()) == {1}
    assert mixing.replicate(make_docs([])).count() == 0
    order = [r["doc_id"] for r in got.collect()]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.1


def test_mixing_distribution_and_join(make_docs, monkeypatch):
    docs = make_docs([(i, "t", "en", "a" if i % 2 else "b", 1) for i in range(3000)])
    few = Counter((r["doc_id"], r["weft_copy"]) for r in mixing.replicate(docs, {"a": 0.9}).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert Counter((r["doc_id"], r["weft_copy"]) for r in mixing.replicate(docs, {"a": 0.9}).collect()) == few
    copies = Counter(i for (i, _) in few if i % 2)
    share = Counter(copies[i] for i in range(1, 3000, 2))
    for k in range(5):
        p = math.exp(-1.8) * 1.8**k / math.factorial(k)
        assert abs(share[k] - 1500 * p) < 5 * math.sqrt(1500 * p)


def test_mixing_large_means(make_docs):
    docs = make_docs([(i, "t", "en", "rare" if i < 20 else "many", 1) for i in range(4000)])
    copies = Counter(r["doc_id"] for r in mixing.replicate(docs, {"rare": 0.5}).where("source = 'rare'").select("doc_id").collect())
    assert len(copies) == 20 and abs(sum(copies.values()) - 2000) < 5 * math.sqrt(2000)
    assert 4 < np.std(list(copies.values())) < 20


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_sharding(make_docs, shards):
    rng = random.Random(4)
    rows = [(i, "é" * rng.randint(0, 50), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), None) for i in range(700)]
    rows += [(1000 + i, "the same text", "en", "a", 3) for i in range(400)] + [(1, None), (1, None), (None, "")]
    got = sharding.kd_shards(make_docs(rows), shards=shards).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(shards))
    assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in by.values())
    sizes = [sum(r["size"] for r in rs) for rs in by.values()]
    assert max(sizes) - min(sizes) <= 4 * 101  # a row more or less at each cut


def test_sharding_keeps_equal_texts_together(make_docs):
    """Copies of other sources and languages too; only groups that are large for a shard may be divided, and few are."""
    rng = random.Random(6)
    rows = [(i, f"text {i // 3} " + "w" * (i // 3 % 40), rng.choice(["en", "de", "fr", None]), rng.choice(["a", "b", "c"]), None) for i in range(3000)]
    rows += [(5000 + i, "copied by all", rng.choice(["en", "de"]), rng.choice(["a", "b"]), None) for i in range(2000)]
    got = sharding.kd_shards(make_docs(rows), shards=8).collect()
    text = {r[0]: r[1] for r in rows}
    held, sizes = defaultdict(set), Counter()
    for r in got:
        held[text[r["doc_id"]]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert {t for t, at in held.items() if len(at) > 1} <= {"copied by all"}
    mean = sum(sizes.values()) / 8
    assert all(abs(n - mean) < 0.04 * mean for n in sizes.values())


@pytest.mark.parametrize("shards", [2, 5, 16])
def test_sharding_of_a_very_long_text(make_docs, shards):
    rows = [(0, "long " * 400_000)] + [(i, f"text {i}") for i in range(1, 200)] + [(None, None), (7, "")]
    got = sharding.kd_shards(make_docs(rows), shards=shards).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows) and all(0 <= r["shard"] < shards for r in got)
    assert [r["size"] for r in got if r["doc_id"] == 0] == [2_000_001]


def test_sharding_by_target_bytes(make_docs):
    docs = make_docs([(i, "x" * 99) for i in range(100)])
    sizes = Counter(r["shard"] for r in sharding.kd_shards(docs, target_bytes=2600).collect())
    assert len(sizes) == 4 and set(sizes.values()) == {25}
    assert sharding.kd_shards(make_docs([]), shards=8).count() == 0


def brute_top(rows, k):
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for q, (query_id, a) in enumerate(whole):
        if query_id % 10 == 0:
            scored = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), i) for c, (i, b) in enumerate(whole) if c != q and len(a) == len(b))[:k]
            out += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [64, 2048])
def test_exact_top_k(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "LEAST_SHARD", shard_rows)
    monkeypatch.setattr(topk, "MOST_SHARD", shard_rows)
    monkeypatch.setattr(topk, "LEAF", 16)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[10][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2010, [None] * 8), (2020, [float("nan")] * 8), (2030, [float("inf")] * 8), (None, rows[0][1]), (20, rows[3][1]), (30, [1.0, 2.0]), (31, [2.0, 2.0]), (2040, [3e12] * 8)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.IntegerType()), T.StructField("score", T.StringType())])
    vectors = stored(spark.createDataFrame([(*r, 1, "s") for r in rows], schema), "test-vectors")
    exact = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute_top(exact, 10)
    got = topk.exact_top_k(vectors, F.col("vec_id") % 10 == 0, k=10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == want
    assert topk.exact_top_k(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0
