import json
import os
from functools import partial

import pytest

from weft.functions import pattern_text, rule_text, truncate
from weft.operators import evaluate, itemsets, patterns, rules
from weft.plans import grid, report
from weft.runtime import scratch_path
from weft.sources import csv, results, text

BASKETS = [("1", ["a", "b", "c"]), ("2", ["a", "b", "c"]), ("3", ["a", "b"]), ("4", ["c"])]


@pytest.fixture()
def baskets(spark):
    return spark.createDataFrame(BASKETS, "tid string, items array<string>")


def test_grid(spark, baskets):
    g = grid.Grid(min_confidence=0.7).add_dataset("toy", baskets)
    for name, miner in itemsets.ALGORITHMS.items():
        g.add_algorithm(name, partial(miner, min_support=0.49))
    g.add_evaluator("coverage", lambda found, r, b: evaluate.coverage(b, found, r))
    result = g.run()
    assert {(c.n_found, c.n_rules, c.n_rows) for c in result.cells.values()} == {(7, 4, 4)}
    total = result.summary().first()
    assert (total.num_datasets, total.num_algorithms, total.num_evaluators) == (1, 3, 1)
    assert (total.total_itemsets_found, total.total_rules_generated) == (21, 12)
    assert result.get("toy", "apriori").found.count() == 7 and result.get("toy", "none") is None
    cover = result.metrics().where("metric = 'rule_coverage'").collect()
    assert [r.value for r in cover] == [0.75] * 3
    assert result.comparison().count() == 3
    path = scratch_path(spark, "grid")
    results.write_grid_json(result, path)
    assert spark.read.json(f"{path}/summary").first().total_itemsets_found == 21
    assert spark.read.json(f"{path}/top_rules/cell=0").count() == 4
    assert grid.time_ratio(result.comparison(), "toy", "toy").first().time_ratio == 1.0


def test_grid_labels(spark, baskets):
    g = grid.Grid().add_dataset("toy", baskets)
    with pytest.raises(ValueError):
        g.add_dataset("toy", baskets)
    with pytest.raises(ValueError):
        g.run()
    with pytest.raises(ValueError):
        grid.Grid().run()


def test_sequential_grid(spark):
    rows = [("s1", 1, ["a"]), ("s1", 2, ["b"]), ("s2", 1, ["a"]), ("s2", 2, ["b"])]
    data = spark.createDataFrame(rows, "sequence_id string, position long, items array<string>")
    g = grid.Grid(sequential=True).add_dataset("d", data).add_algorithm("p", partial(patterns.prefixspan, min_support=1.0))
    cell = g.run().get("d", "p")
    assert (cell.n_rows, cell.n_found, cell.n_rules) == (2, 3, 1)


def test_sweeps_list_every_threshold(spark, baskets):
    sets = itemsets.apriori(baskets, 0.49)
    sweep = grid.support_sweep(sets, 4, [0.5, 0.75, 1.0]).collect()
    assert {(r.min_support, r.n_found) for r in sweep} == {(0.5, 7), (0.75, 4), (1.0, 0)}
    found = rules.association_rules(sets, "confidence", 0.5)
    got = {r.min_confidence: (r.n_rules, r.avg_lift) for r in grid.confidence_sweep(found, [0.7, 2.0]).collect()}
    assert got[2.0] == (0, 0.0) and got[0.7][0] == 4
    none = grid.confidence_sweep(found.where("false"), [0.7]).collect()
    assert [(r.n_rules, r.avg_lift) for r in none] == [(0, 0.0)]


def test_fastest(spark):
    t = spark.createDataFrame([("x", 0.1, 10, 2.0), ("y", 0.1, 10, 1.0)], "algorithm string, min_support double, n_found long, seconds double")
    assert tuple(grid.fastest(t).first()) == (0.1, "y", 1.0, 10.0, 3.0)
    assert evaluate.run_profile(0.0, 1, 1, 1)["rules_per_second"] == 0.0


def test_texts(spark):
    df = spark.createDataFrame([(["b", "a"], ["c"], [["b", "a"], ["c"]])], "x array<string>, y array<string>, p array<array<string>>")
    got = df.select(rule_text("x", "y"), pattern_text("p"), truncate(rule_text("x", "y"), 6)).first()
    assert tuple(got) == ("{a, b} -> {c}", "<{a, b}, {c}>", "{a, b}")


def test_top_rules_breaks_ties_by_name(spark, baskets):
    found = rules.association_rules(itemsets.apriori(baskets, 0.49), "confidence", 0.0)
    top = report.top_rules(found, 2).collect()
    assert [(r.antecedent, r.consequent) for r in top] == [(["a"], ["b"]), (["a", "c"], ["b"])]


def _write(path, lines):
    os.makedirs(path)
    with open(f"{path}/part.csv", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_dialect(spark):
    path = scratch_path(spark, "dialect")
    _write(path, [" a ;b; c", "1;2,5;x", "2;3,5", "3;4,5;y;z", "4;5,5;w", "5;6,5;y;", '6;7,5;"q;""r"";s"', '7;8,5;"q;r";'])
    df = csv.scan_csv_dialect(spark, path, [" a ", "b", " c"], decimal_columns=["b"])
    want = [("1", 2.5, "x"), ("2", 3.5, None), ("4", 5.5, "w"), ("6", 7.5, 'q;"r";s')]
    assert df.columns == ["a", "b", "c"] and sorted(tuple(r) for r in df.collect()) == want
    assert df.select("a").count() == 4


def test_csv_quotes_and_line_breaks(spark):
    path = scratch_path(spark, "quotes")
    _write(path, ["id,what", '1,"say ""hi"", x"', '2,"two\nlines"', "3,#plain"])
    got = {r.id: r.what for r in csv.scan_csv(spark, path, "id int, what string", multi_line=True).collect()}
    assert got == {1: 'say "hi", x', 2: "two\nlines", 3: "#plain"}
    got = {r.id: r.what for r in csv.scan_csv(spark, path, "id int, what string", multi_line=True, nullValue="#plain").collect()}
    assert got[3] is None


def test_csv_scan(spark):
    path = scratch_path(spark, "scan")
    _write(path, [" id ,when", "1,01.02.2024 10:30", "2,never"])
    df = csv.scan_csv(spark, path, parse_date_columns=["when"], date_format="dd.MM.yyyy HH:mm")
    got = sorted((r.id, str(r.when)) for r in df.collect())
    assert got == [(1, "2024-02-01 10:30:00"), (2, "None")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv.scan_csv(spark, path + "-absent")


def test_sample_is_stable_and_whole_when_small(spark):
    df = spark.range(50)
    assert csv.sample_rows(df, "id", 100).count() == 50
    one = {r.id for r in csv.sample_rows(df, "id", 10).collect()}
    assert len(one) == 10 and one == {r.id for r in csv.sample_rows(df.repartition(7), "id", 10).collect()}


def test_pattern_text(spark):
    coded = spark.createDataFrame([("s", 1, [2, 1]), ("s", 2, [3])], "sequence_id string, position long, items array<int>")
    assert [r.value for r in text.sequence_lines(coded).collect()] == ["1 2 -1 3 -1 -2"]
    lines = [("1 -1 3 -1 #SUP: 42",), ("no support",), ("1 2 -1 -2 9 -1 #SUP: 7",), ("",), ("10 -1 #SUP: 1",)]
    df = spark.createDataFrame(lines, "value string")
    plain = sorted((r.support_count, r.elements) for r in text.parse_pattern_lines(df).collect())
    assert plain == [(1, [["10"]]), (7, [["1", "2"]]), (42, [["1"], ["3"]])]
    names = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "item string, item_id long")
    twice = spark.createDataFrame([("1 -1 2 -1 #SUP: 5",), ("1 -1 2 -1 #SUP: 5",)], "value string")
    assert [r.elements for r in text.parse_pattern_lines(twice, names).collect()] == [[["b"], ["a"]]] * 2
    decoded = sorted((r.support_count, r.elements) for r in text.parse_pattern_lines(df, names).collect())
    assert decoded == [(1, [["10"]]), (7, [["b", "a"]]), (42, [["b"], ["c"]])]


def test_json_writes_infinity_as_text(spark, baskets):
    found = rules.association_rules(itemsets.apriori(baskets, 0.49), "confidence", 1.0)
    path = scratch_path(spark, "json")
    results.write_json(found, path)
    rows = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert {r["conviction"] for r in rows} == {"inf"} and all(isinstance(r["lift"], float) for r in rows)


def test_csv_sink(spark, baskets):
    path = scratch_path(spark, "sink")
    results.write_csv(itemsets.apriori(baskets, 0.49), path)
    assert csv.scan_csv(spark, path).where("items = 'a|b|c'").first().support_count == 2


def test_csv_dialect_with_a_long_quoted_field(spark):
    """A surplus field beside a quoted one of 100,000 characters, with doubled quotes and separators inside."""
    path = scratch_path(spark, "dialect-long")
    long = '"' + 'a;""b""' * 15_000 + '"'
    spark.createDataFrame([("a;b",), (f"{long};1",), (f"{long};1;2",), ('"x;y";2',)], "value string").coalesce(1).write.text(path)
    got = csv.scan_csv_dialect(spark, path, ["a", "b"]).collect()
    assert sorted((len(r["a"]), r["b"]) for r in got) == [(3, "2"), (75_000, "1")]
