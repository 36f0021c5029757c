import random

import pytest
from pyspark.sql import functions as F

import weft.operators.itemsets as itemsets
from brute import itemsets as brute
from weft import runtime
from weft.functions import min_count
from weft.operators import baskets, evaluate, rules

TOY = [("T1", ["a", "b", "c"]), ("T2", ["a", "b", "c"]), ("T3", ["a", "b"]), ("T4", ["c"])]
SCHEMA = "tid string, items array<string>"


def found(df):
    return {tuple(r["items"]): r.support_count for r in df.collect()}


@pytest.mark.parametrize("name", itemsets.ALGORITHMS)
def test_toy(spark, name):
    got = itemsets.ALGORITHMS[name](spark.createDataFrame(TOY, SCHEMA), 0.49)
    assert found(got) == {
        ("a",): 3, ("b",): 3, ("c",): 3, ("a", "b"): 3, ("a", "c"): 2, ("b", "c"): 2, ("a", "b", "c"): 2,
    }
    assert {r.support for r in got.collect()} == {0.75, 0.5}


@pytest.mark.parametrize("name", itemsets.ALGORITHMS)
def test_threshold_edge(spark, name):
    data = [(str(n), ["a", "z"] if n < 7 else ["z"]) for n in range(100)]
    got = found(itemsets.ALGORITHMS[name](spark.createDataFrame(data, SCHEMA), 0.07))
    assert got == {("a",): 7, ("z",): 100, ("a", "z"): 7}
    assert min_count(0.07, 100) == 7


@pytest.mark.parametrize("name", itemsets.ALGORITHMS)
def test_random_against_brute_force(spark, name):
    rng = random.Random(5)
    data = [(str(n), sorted({rng.choice("abcdefg") for _ in range(rng.randint(1, 6))})) for n in range(150)]
    # a third of the baskets are copies of one
    data += [(f"copy{n}", ["a", "c", "e", "g"]) for n in range(75)]
    want = brute([b for _, b in data], min_count(0.1, len(data)))
    df = spark.createDataFrame(data, SCHEMA)
    assert found(itemsets.ALGORITHMS[name](df, 0.1)) == want
    short = {k: v for k, v in want.items() if len(k) <= 2}
    assert found(itemsets.ALGORITHMS[name](df, 0.1, max_len=2)) == short
    assert found(itemsets.ALGORITHMS[name](df, 0.1, max_len=1)) == {k: v for k, v in want.items() if len(k) == 1}


def test_joins_without_broadcast(spark, monkeypatch):
    rng = random.Random(8)
    data = [(str(n), sorted({rng.choice("abcdefgh") for _ in range(5)})) for n in range(200)]
    df = spark.createDataFrame(data, SCHEMA)
    want = brute([b for _, b in data], min_count(0.05, len(data)))
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 0)
    assert found(itemsets.apriori(df, 0.05)) == want
    assert found(itemsets.eclat(df, 0.05)) == want


@pytest.mark.parametrize("tile", [1, 2, 3])
def test_baskets_in_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(itemsets, "TILE", tile)
    rng = random.Random(13)
    data = [(str(n), sorted(rng.sample("abcdefgh", rng.randint(1, 8)))) for n in range(80)]
    df = spark.createDataFrame(data, SCHEMA)
    want = brute([b for _, b in data], min_count(0.2, len(data)))
    assert found(itemsets.apriori(df, 0.2)) == want
    assert found(itemsets.eclat(df, 0.2)) == want


def test_pairs_of_a_huge_basket_are_dealt_over_tasks(spark):
    reduced = spark.range(3).select(F.col("id").alias("tid"), F.expr("sequence(0, 2000)").alias("ids")).coalesce(1)
    parts = itemsets._basket_pairs(reduced).groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    sizes = [r.n for r in parts.collect()]
    assert sum(sizes) == 3 * 2001 * 2000 // 2 and max(sizes) < sum(sizes) * 0.6
    counted = itemsets.count_pairs(reduced).groupBy("support_count").agg(F.count(F.lit(1)).alias("n")).collect()
    assert [(r.support_count, r.n) for r in counted] == [(3, 2001 * 2000 // 2)]


def test_covered_baskets_against_brute_force(spark):
    rng = random.Random(19)
    data = [(str(n), sorted(rng.sample("abcdefgh", rng.randint(1, 5)))) for n in range(120)]
    sets = [["a"], ["a", "b"], ["c", "d"], ["d", "c"], ["e", "f", "g"], ["b", "zz"], ["h", "b"]]
    df = spark.createDataFrame(data, SCHEMA)
    for given in (sets, sets[1:]):
        table = spark.createDataFrame([(x,) for x in given], "items array<string>")
        got = sorted(r.tid for r in evaluate._covered_baskets(df, table).collect())
        assert got == sorted(tid for tid, b in data if any(set(x) <= set(b) for x in given))


def test_masks_span_cells(spark, monkeypatch):
    monkeypatch.setattr(itemsets, "BASKETS_PER_CELL", 100)
    coded = spark.range(1000).select(F.col("id").alias("tid"), F.explode(F.array(F.lit(0), (F.col("id") % 3 + 1).cast("int"))).alias("id"))
    masks = itemsets.tid_masks(coded, 1000)
    counts = {r["x"]: r["n"] for r in masks.groupBy("x").agg(F.sum(F.bit_count("mask")).alias("n")).collect()}
    assert counts == {0: 1000, 1: 334, 2: 333, 3: 333}


def test_null_items_of_a_custom_builder_do_not_count(spark):
    made = baskets.custom(spark.range(1), lambda d: d.sparkSession.createDataFrame([(1, ["a", None]), (2, ["a", None, "b"]), (3, ["b"])], "tid long, items array<string>"))
    for mine in itemsets.ALGORITHMS.values():
        got = {tuple(r["items"]): (r["support_count"], round(r["support"], 3)) for r in mine(made, 0.5).collect()}
        assert got == {("a",): (2, 0.667), ("b",): (2, 0.667)}
    assert {r["item"]: round(r["support"], 3) for r in baskets.item_support(made).collect()} == {"a": 0.667, "b": 0.667}


def test_rules_of_a_huge_itemset_are_an_error(spark):
    huge = spark.createDataFrame([([f"i{n}" for n in range(64)], 64, 1, 0.5)], "items array<string>, size int, support_count long, support double")
    with pytest.raises(Exception, match="more items than can be split"):
        rules.association_rules(huge, "support", 0.0).collect()


def test_no_baskets_and_nothing_frequent(spark):
    empty = spark.createDataFrame([], SCHEMA)
    lone = spark.createDataFrame([("1", ["a"]), ("2", ["b"]), ("3", ["c"])], SCHEMA)
    for mine in itemsets.ALGORITHMS.values():
        assert mine(empty, 0.5).count() == 0
        assert mine(lone, 0.5).count() == 0
        none = rules.association_rules(mine(lone, 0.1), "confidence", 0.1)
        assert none.count() == 0
        assert evaluate.rule_quality(none).first().avg_lift == 0.0


def test_toy_rules_and_evaluators(spark):
    df = spark.createDataFrame(TOY, SCHEMA)
    sets = itemsets.apriori(df, 0.49)
    every = rules.association_rules(sets, "confidence", 0.0)
    got = {(tuple(r.antecedent), tuple(r.consequent)): r for r in every.collect()}
    assert len(got) == 12
    sure = got[("a",), ("b",)]
    assert (sure.support, sure.confidence, sure.conviction) == (0.75, 1.0, float("inf"))
    assert sure.lift == pytest.approx(4 / 3) and sure.leverage == pytest.approx(0.1875)
    weak = got[("a", "b"), ("c",)]
    assert weak.confidence == pytest.approx(2 / 3) and weak.lift == pytest.approx(8 / 9)
    assert weak.conviction == pytest.approx(0.75) and weak.leverage == pytest.approx(-0.0625)
    assert rules.association_rules(sets, "confidence", 0.7).count() == 4
    assert rules.association_rules(sets, "lift", 1.0).count() == 6
    cover = evaluate.coverage(df, sets, rules.association_rules(sets, "confidence", 0.7)).first()
    assert (cover.item_coverage, cover.transaction_coverage, cover.rule_coverage) == (1.0, 1.0, 0.75)
    quality = evaluate.rule_quality(every).first()
    assert quality.redundancy_ratio == 0.5
    shape = evaluate.itemset_shape(sets).first()
    assert (shape.memory_efficiency, shape.max_itemset_size) == (0.25, 3)
    assert {(r.size, r.n) for r in evaluate.size_distribution(sets).collect()} == {(1, 3), (2, 3), (3, 1)}


def test_rule_invariants(spark):
    rng = random.Random(11)
    data = [(str(n), sorted({rng.choice("abcdef") for _ in range(4)})) for n in range(120)]
    sets = itemsets.fpgrowth(spark.createDataFrame(data, SCHEMA), 0.05)
    got = {(tuple(r.antecedent), tuple(r.consequent)): r for r in rules.association_rules(sets, "confidence", 0.0).collect()}
    for (a, c), r in got.items():
        assert r.lift == pytest.approx(got[c, a].lift)
        assert r.leverage <= 0.25


def test_large_itemset_splits(spark):
    items = [f"i{n:02d}" for n in range(14)]
    one = spark.createDataFrame([(items, 14, 5, 1.0)], "items array<string>, size int, support_count long, support double")
    got = rules._splits(one)
    assert got.count() == 2**14 - 2
    assert got.distinct().count() == 2**14 - 2
    assert got.where(F.size("antecedent") + F.size("consequent") != 14).count() == 0


def test_coverage_without_singles(spark):
    df = spark.createDataFrame(TOY, SCHEMA)
    pairs = itemsets.apriori(df, 0.49).where("size >= 2")
    none = rules.association_rules(pairs, "confidence", 2.0)
    cover = evaluate.coverage(df, pairs, none).first()
    assert (cover.transaction_coverage, cover.rule_coverage) == (0.75, 0.0)


def test_histogram_top_edge(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (float("inf"),)], "v double")
    assert sorted((r.bin, r.n) for r in evaluate.histogram(df, "v", 4).collect()) == [(1, 1), (2, 0), (3, 1), (4, 1)]


@pytest.mark.parametrize("max_len", [2, 3, 5])
def test_bounded_fpgrowth_makes_no_longer_set(spark, monkeypatch, max_len):
    rng, made, keep = random.Random(max_len), [], itemsets.durable

    def watched(df):
        out = keep(df)
        if {"ids", "path"} <= set(out.columns):
            made.extend(r["k"] for r in out.select((F.size("ids") + 1).alias("k")).distinct().collect())
        return out

    monkeypatch.setattr(itemsets, "durable", watched)
    monkeypatch.setattr(itemsets, "FPGrowth", None)
    data = [sorted(rng.sample("abcdefg", rng.randint(1, 6))) for _ in range(80)] + [["a", "b", "c", "d"]] * 20
    df = spark.createDataFrame(list(enumerate(data)), "tid long, items array<string>")
    want = {s: n for s, n in brute(data, min_count(0.1, len(data))).items() if len(s) <= max_len}
    got = {tuple(r["items"]): r["support_count"] for r in itemsets.fpgrowth(df, 0.1, max_len=max_len).collect()}
    assert got == want and max(made) <= max_len


def test_confident_rules_of_an_itemset_of_sixty(spark):
    """Two consequents reach the bound alone, and together; no other split is made."""
    items = [f"i{n:02d}" for n in range(60)]
    without = lambda *gone: [i for i in items if i not in gone]
    rows = [(items, 100)] + [(without(i), 100 if i in ("i07", "i31") else 1000) for i in items] + [(without("i07", "i31"), 105), (without("i07", "i08"), 5000)]
    rows += [([i], 100_000) for i in items] + [(["i07", "i31"], 50_000)]
    table = spark.createDataFrame([(s, len(s), n, n / 1e6) for s, n in rows], "items array<string>, size int, support_count long, support double")
    got = {(tuple(r.antecedent), tuple(r.consequent)): r.confidence for r in rules.association_rules(table, "confidence", 0.9).collect()}
    both = tuple(without("i07", "i31"))  # also the antecedent of rules of the two sets of 59 items
    assert got == {
        (tuple(without("i07")), ("i07",)): 1.0, (tuple(without("i31")), ("i31",)): 1.0, (both, ("i07", "i31")): 100 / 105,
        (both, ("i07",)): 100 / 105, (both, ("i31",)): 100 / 105,
    }


@pytest.mark.parametrize("bound", [0.0, 0.3, 0.6, 0.95])
def test_grown_rules_are_all_rules(spark, bound):
    rng = random.Random(4)
    data = [sorted(rng.sample("abcde", rng.randint(1, 5))) for _ in range(60)]
    counts = brute(data, 3)
    table = spark.createDataFrame([(list(s), len(s), n, n / 60) for s, n in counts.items()], "items array<string>, size int, support_count long, support double")
    got = {(tuple(r.antecedent), tuple(r.consequent)): r.support_count for r in rules.association_rules(table, "confidence", bound).collect()}
    want = {}
    for s, n in counts.items():
        for mask in range(1, 2 ** len(s) - 1):
            a = tuple(x for i, x in enumerate(s) if mask >> i & 1)
            if n / counts[a] >= bound:
                want[a, tuple(x for x in s if x not in a)] = n
    assert got == want


def test_broadcasts_are_checked_by_real_lengths(spark):
    rows = spark.range(10).select(F.array([F.repeat(F.lit("x"), 1000)] * 1000).alias("items"))
    assert runtime.table_bytes(rows, 10) >= 10_000_000
    texts = spark.range(10).select(F.repeat(F.lit("y"), 5000).alias("text"), F.array(F.array(F.lit(1), F.lit(2))).alias("els"))
    assert 50_000 <= runtime.table_bytes(texts, 10) < 60_000
    assert runtime.table_bytes(spark.range(10), 10) == 80


def test_equal_baskets_are_one_row_with_their_number(spark):
    data = [["a", "b", "c"]] * 300 + [["a", "b"]] * 101 + [["b", "c", "z"]] * 7 + [["c"]] * 50
    df = spark.createDataFrame([(str(n), b) for n, b in enumerate(data)], SCHEMA)
    enc = itemsets.encode(df, 0.1)
    assert (enc.n, enc.n_items) == (458, 3)
    assert {tuple(r["ids"]): r["n"] for r in itemsets.reduced_baskets(enc).collect()} == {(0, 1, 2): 300, (0, 1): 101, (1, 2): 7}
    for mine in itemsets.ALGORITHMS.values():
        assert found(mine(df, 0.1)) == brute(data, min_count(0.1, len(data)))


@pytest.mark.parametrize("name", itemsets.ALGORITHMS)
def test_rows_of_one_tid_are_baskets_of_their_own(spark, monkeypatch, name):
    monkeypatch.setattr(itemsets, "ROW_ITEMS", 2)
    data = [("x", ["a", "b", "c"]), ("x", ["a", "b"]), ("y", ["b", "c"]), (None, ["a", "b"]), (None, ["a"])]
    assert found(itemsets.ALGORITHMS[name](spark.createDataFrame(data, SCHEMA), 0.2)) == brute([b for _, b in data], 1)


def test_transactions_of_a_common_basket_are_dealt_over_tasks(spark):
    reduced = spark.createDataFrame([([0, 1], 1003), ([1, 2], 5)], "ids array<int>, n long")
    rows = itemsets._transactions(reduced, 1008, 4)
    assert {tuple(r["ids"]): r["count"] for r in rows.groupBy("ids").count().collect()} == {(0, 1): 1003, (1, 2): 5}
    parts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert max(parts) < 800


def test_coverage_counts_a_repeated_tid_once(spark):
    df = spark.createDataFrame([("x", ["a"]), ("x", ["a"]), ("y", ["a"]), ("z", ["b"])], SCHEMA)
    sets = spark.createDataFrame([(["a"],)], "items array<string>")
    nothing = spark.createDataFrame([], "antecedent array<string>")
    row = evaluate.coverage(df, sets, nothing).first()
    assert (row.total_transactions, row.transactions_with_itemsets, row.transactions_with_rules) == (4, 2, 0)
    row = evaluate.coverage(df.where("tid <> 'x'").unionByName(df.limit(1)), sets, nothing).first()
    assert (row.total_transactions, row.transactions_with_itemsets) == (3, 2)
