from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weft.operators import baskets, clean, sequences


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_grouped_drops_or_names_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "a"), (2, None)], "k long, v string")
    assert rows(baskets.grouped(df, "k", "v"), "tid", "items") == [(1, ["a", "b"])]
    literal = baskets.grouped(df, "k", "v", null_items="literal")
    assert rows(literal, "tid", "items") == [(1, ["a", "b"]), (2, ["nan"])]


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    for call in (
        lambda: baskets.grouped(df, "x", "v"),
        lambda: sequences.temporal(df, "k", "v", "t"),
        lambda: sequences.events(df, "k", "v", "t", "k"),
        lambda: sequences.sessions(df, "k", "v", "t", "k"),
    ):
        with pytest.raises(KeyError):
            call()
    with pytest.raises(ValueError):
        baskets.from_rows(df, "k")


def test_delimited_and_wide(spark):
    df = spark.createDataFrame([(1, "a | b||a"), (2, "  "), (3, None)], "k long, v string")
    assert rows(baskets.delimited(df, "k", "v", "|"), "tid", "items") == [(1, ["a", "b"])]
    wide = spark.createDataFrame([(1, " x ", None, "", "x"), (2, None, None, "", None)], "k long, a string, b string, c string, d string")
    assert rows(baskets.wide(wide, "k", ["a", "b", "c", "d", "z"]), "tid", "items") == [(1, ["x"])]
    assert baskets.wide(wide, "k", ["z"]).count() == 0


def test_basket_stats_and_support(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "tid long, items array<string>")
    stats = baskets.basket_stats(df).first()
    assert (stats.n_baskets, stats.avg_items, stats.max_items, stats.min_items, stats.n_items) == (2, 1.5, 2, 1, 2)
    assert not stats.single_item_only
    assert rows(baskets.item_support(df), "item", "support_count", "support") == [("a", 2, 1.0), ("b", 1, 0.5)]


def test_clean_rows_and_profile(spark):
    df = spark.createDataFrame([("1", " a "), ("x", "b"), (None, "c"), ("2", None)], "k string, v string")
    assert sorted(clean.clean_rows(df, "k", "v", integer_key=True).collect(), key=str) == [(1, "a"), (None, "b")]
    assert rows(clean.null_profile(df, ["k"]), "n_null", "null_share") == [(1, 0.25)]


T0 = datetime(2024, 1, 1)


def test_sessions_gap_is_strict(spark):
    data = [
        ("u1", T0, "a", 1), ("u1", T0 + timedelta(minutes=30), "b", 2),
        ("u1", T0 + timedelta(minutes=60, seconds=1), "a", 3), ("u2", T0, "c", 4),
    ]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(data, f"u string, t {kind}, i string, n long")
        out = sequences.assemble(sequences.sessions(df, "u", "i", "t", "n", 30))
        assert rows(out, "sequence_id", "elements") == [
            ("u1_0", [["a"], ["b"]]), ("u1_1", [["a"]]), ("u2_0", [["c"]]),
        ]


def test_null_times(spark):
    data = [("u", T0, "a", 1), ("u", None, "z", 2), ("u", T0 + timedelta(hours=9), "b", 3)]
    df = spark.createDataFrame(data, "u string, t timestamp_ntz, i string, n long")
    assert rows(sequences.assemble(sequences.temporal(df, "u", "i", "t")), "elements") == [([["a"], ["b"]],)]
    assert rows(sequences.assemble(sequences.events(df, "u", "i", "t", "n")), "elements") == [([["a"], ["b"], ["z"]],)]
    named = sequences.assemble(sequences.sessions(df, "u", "i", "t", "n", 30))
    assert rows(named, "sequence_id", "elements") == [("u_0", [["a"]]), ("u_1", [["b"], ["z"]])]


def _uneven(spark):
    """One key with most of the rows, ties on time, a null time, and long gaps."""
    data = []
    for n in range(300):
        data.append(("hot", T0 + timedelta(minutes=(n * 7) % 250 * (3 if n % 5 else 40)), f"i{n % 6}", n))
    data.append(("hot", None, "last", 1000))
    for n in range(40):
        data.append((f"k{n % 8}", T0 + timedelta(minutes=n * 11), f"i{n % 4}", n))
    return spark.createDataFrame(data, "u string, t timestamp_ntz, i string, n long")


@pytest.mark.parametrize("hot_rows", [25, 60])
def test_hot_keys_in_slices_equal_the_plain_window(spark, hot_rows):
    df = _uneven(spark)
    same = lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert same(sequences.temporal(df, "u", "i", "t", hot_rows=hot_rows), sequences.temporal(df, "u", "i", "t"))
    assert same(sequences.events(df, "u", "i", "t", "n", hot_rows=hot_rows), sequences.events(df, "u", "i", "t", "n"))
    for gap in (10, 60, 400):
        assert same(
            sequences.sessions(df, "u", "i", "t", "n", gap, hot_rows=hot_rows),
            sequences.sessions(df, "u", "i", "t", "n", gap),
        )


def test_by_transaction_orders_by_first_time(spark):
    data = [
        ("c", "t2", "b", T0), ("c", "t1", "a", T0 + timedelta(days=1)), ("c", "t2", "a", T0 + timedelta(days=2)),
        ("c", "t0", " x ", T0 + timedelta(days=1)),
    ]
    df = spark.createDataFrame(data, "c string, b string, i string, t timestamp_ntz")
    out = sequences.assemble(sequences.by_transaction(df, "c", "b", "i", "t"))
    assert rows(out, "elements") == [([["a", "b"], ["x"], ["a"]],)]


def test_dictionary_is_sorted_and_dense(spark):
    items = spark.range(1000).select(F.concat(F.lit("i"), F.lpad(((F.col("id") * 7919) % 500).cast("string"), 4, "0")).alias("item"))
    got = {r.item: r.item_id for r in sequences.item_dictionary(items).collect()}
    assert got == {item: n + 1 for n, item in enumerate(sorted(got))} and len(got) == 500


def test_hot_keys_with_one_time_or_none_are_sliced(spark):
    rows = [("nulls", None, n) for n in range(1000)] + [("once", datetime(2024, 1, 1), n) for n in range(1000)]
    rows += [("crowd", datetime(2024, 1, 1), 0), *[("crowd", datetime(2025, 1, 1, 0, 0, n % 50), n) for n in range(1, 1000)], ("few", None, 1)]
    df = spark.createDataFrame(rows, "u string, t timestamp, n int").repartition(5)
    cut, any_hot = sequences._sliced(df, ["u"], "t", ["n"], 100)
    sizes = cut.groupBy("u", "_slice").count().collect()
    assert any_hot and max(r["count"] for r in sizes) <= 100
    assert {r["u"] for r in sizes if r["_slice"] == 0} == {"few"}
    got = sequences.number_rows(df, ["u"], "t", ["n"], hot_rows=100)
    want = sequences.number_rows(df, ["u"], "t", ["n"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_baskets_by_id(spark):
    rows = spark.createDataFrame([(1, ["b", "a"]), (2, ["c"]), (3, ["a", "c", "z"])], "tid long, items array<string>")
    dictionary = sequences.item_dictionary(baskets.explode_items(rows).where("item <> 'z'"))
    coded = baskets.encode(rows, dictionary)
    assert {r["tid"]: r["items"] for r in coded.collect()} == {1: [1, 2], 2: [3], 3: [1, 3]}
    assert {r["tid"]: r["items"] for r in baskets.decode(coded, dictionary).collect()} == {1: ["a", "b"], 2: ["c"], 3: ["a", "c"]}
    assert {r["tid"]: r["indices"] for r in baskets.one_hot_sparse(rows, dictionary).collect()} == {1: [0, 1], 2: [2], 3: [0, 2]}


def test_one_hot_of_a_large_vocabulary(spark):
    rows = spark.range(100_000).select((F.col("id") % 1000).alias("tid"), F.array(F.concat(F.lit("item"), F.col("id").cast("string"))).alias("items"))
    dictionary = sequences.item_dictionary(baskets.explode_items(rows))
    places = baskets.one_hot_sparse(rows, dictionary).select(F.explode("indices").alias("at"))
    assert places.agg(F.min("at"), F.max("at"), F.countDistinct("at")).first()[:] == (0, 99_999, 100_000)


def test_transactions_are_read_once(spark):
    """The rows' own join is done once, for row numbers, sizes of keys and readers alike."""
    rows = spark.createDataFrame([(1, 7, "b", 2), (1, 7, "a", 1), (1, 7, "a", 3), (1, 5, "c", 1), (2, 9, "a", None)], "k long, t long, x string, at int")
    joined = rows.select("k", "t", "x", F.timestamp_seconds("at").alias("at")).join(spark.range(1, 3).withColumnRenamed("id", "k"), "k")
    made = sequences.by_transaction(joined, "k", "t", "x", "at")
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.sequence_id, r.position, r["items"]) for r in made.collect()) == [(1, 1, ["c"]), (1, 2, ["a", "b"])]
