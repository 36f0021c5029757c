import random

import pytest
from pyspark.sql import functions as F

import weft.operators.patterns as patterns
from brute import contains, patterns as brute
from weft.functions import contains_pattern, min_count, pattern_key
from weft.operators import evaluate, rules

TOY = {"S1": [["a", "c"], ["a", "b"]], "S2": [["a"], ["b"]], "S3": [["a", "b", "c"]]}


def elements(spark, data):
    rows = [(sid, n + 1, e) for sid, seq in data.items() for n, e in enumerate(seq)]
    return spark.createDataFrame(rows, "sequence_id string, position long, items array<string>")


def found(df):
    return {tuple(tuple(e) for e in r.elements): r.support_count for r in df.collect()}


@pytest.mark.parametrize("name", patterns.ALGORITHMS)
def test_toy(spark, name):
    got = patterns.ALGORITHMS[name](elements(spark, TOY), 0.5)
    assert found(got) == {
        (("a",),): 3, (("b",),): 3, (("c",),): 2, (("a", "c"),): 2, (("a", "b"),): 2, (("a",), ("b",)): 2,
    }
    rule = rules.sequential_rules(got, 0.5).collect()
    assert [(r.antecedent, r.consequent) for r in rule] == [([["a"]], [["b"]])]
    assert rule[0].confidence == pytest.approx(2 / 3) and rule[0].lift == pytest.approx(2 / 3)
    cover = evaluate.sequence_coverage(elements(spark, TOY), got, rules.sequential_rules(got, 0.5)).first()
    assert (cover.sequences_matched, cover.unique_pattern_elements, cover.total_pattern_elements) == (3, 5, 7)


def _random(seed, n=60):
    rng = random.Random(seed)
    data = {}
    for s in range(n):
        data[f"s{s}"] = [sorted({rng.choice("abcd") for _ in range(rng.randint(1, 3))}) for _ in range(rng.randint(1, 6))]
    return data


@pytest.mark.parametrize("name", patterns.ALGORITHMS)
def test_random_against_brute_force(spark, name):
    data = _random(3)
    want = brute(list(data.values()), min_count(0.3, len(data)), 4)
    df = elements(spark, data)
    assert found(patterns.ALGORITHMS[name](df, 0.3, max_items=4)) == want
    short = {p: n for p, n in want.items() if len(p) <= 2}
    assert found(patterns.ALGORITHMS[name](df, 0.3, max_items=4, max_elements=2)) == short
    singles = {p: n for p, n in want.items() if sum(map(len, p)) == 1}
    assert found(patterns.ALGORITHMS[name](df, 0.3, max_items=1)) == singles


@pytest.mark.parametrize("name", ["gsp", "spade", "cm_spade"])
def test_long_sequences_in_chunks(spark, name, monkeypatch):
    monkeypatch.setattr(patterns, "CHUNK", 4)
    rng = random.Random(17)
    data = _random(9, 20)
    data["hot"] = [sorted({rng.choice("abcd") for _ in range(2)}) for _ in range(60)]
    want = brute(list(data.values()), min_count(0.3, len(data)), 4)
    assert found(patterns.ALGORITHMS[name](elements(spark, data), 0.3, max_items=4)) == want


def test_prefixspan_holds_no_sequence_whole(spark, monkeypatch):
    monkeypatch.setattr(patterns, "CHUNK", 8)
    rng, keep, longest = random.Random(23), patterns.durable, []

    def watched(df, *rest):
        out = keep(df, *rest)
        longest.extend(out.agg(F.max(F.size(f.name))).first()[0] or 0 for f in out.schema if f.dataType.typeName() == "array")
        return out

    monkeypatch.setattr(patterns, "durable", watched)
    data = _random(29, 12) | {"long": [[rng.choice("abcd")] for _ in range(400)]}
    want = brute(list(data.values()), min_count(0.4, len(data)), 2)
    assert found(patterns.prefixspan(elements(spark, data), 0.4, max_items=2)) == want
    assert 0 < max(longest) <= 8


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_prefixspan_grows_by_itself(spark, monkeypatch, seed):
    """Nothing of the candidate miners is used, and results are those of brute force, also of wide elements over many chunks."""
    for name in ("_class_candidates", "_grow", "_advance", "_candidates", "_count_after", "_vertical", "_count_later", "_meet", "_later"):
        monkeypatch.setattr(patterns, name, None)
    monkeypatch.setattr(patterns, "CHUNK", 3)
    rng = random.Random(seed)
    data = {f"s{s}": [sorted(rng.sample("abcde", rng.randint(1, 4))) for _ in range(rng.randint(0, 7))] or [["a"]] for s in range(40)}
    data["hot"] = [sorted(rng.sample("abcde", 2)) for _ in range(40)]
    want = brute(list(data.values()), min_count(0.4, len(data)), 5)
    assert found(patterns.prefixspan(elements(spark, data), 0.4, max_items=5)) == want
    short = {p: n for p, n in want.items() if len(p) <= 2}
    assert found(patterns.prefixspan(elements(spark, data), 0.4, max_items=5, max_elements=2)) == short


@pytest.mark.parametrize("name", ["spade", "cm_spade"])
def test_spade_joins_idlists_only(spark, monkeypatch, name):
    """No occurrences, match states or projections; masks of several blocks, with the top bit of a block set and set alone."""
    for other in ("_grow", "_item_occurrences", "_intersect", "_advance", "_count_after", "_step", "_Projected"):
        monkeypatch.setattr(patterns, other, None)
    rng = random.Random(41)
    data = {f"s{s}": [sorted(rng.sample("abcd", rng.randint(1, 3))) for _ in range(rng.randint(1, 6))] for s in range(30)}
    rows = [(sid, 62 + n, e) for sid, seq in data.items() for n, e in enumerate(seq)]
    for n in range(8):  # ends at the top bits of blocks only
        data[f"top{n}"] = [["a"], ["a", "b"], ["b"], ["c"]]
        rows += [(f"top{n}", 64 * b + 63, e) for b, e in enumerate(data[f"top{n}"])]
    data["hot"] = [sorted(rng.sample("abcd", 2)) for _ in range(300)]
    rows += [("hot", n + 1, e) for n, e in enumerate(data["hot"])]
    df = spark.createDataFrame(rows, "sequence_id string, position long, items array<string>")
    want = brute(list(data.values()), min_count(0.3, len(data)), 4)
    assert found(patterns.ALGORITHMS[name](df, 0.3, max_items=4)) == want
    short = {p: n for p, n in want.items() if len(p) <= 2}
    assert found(patterns.ALGORITHMS[name](df, 0.3, max_items=4, max_elements=2)) == short


@pytest.mark.parametrize("name", ["prefixspan", "spade", "cm_spade"])
def test_short_sequences_are_mined_row_by_row(spark, monkeypatch, name):
    """No join of id-lists or projections, up to the last position of a block, with repeated elements."""
    for other in ("_count_later", "_meet", "_later", "_bounds", "_Projected", "_step"):
        monkeypatch.setattr(patterns, other, None)
    data = _random(47, 30)
    rows = [(sid, 64 - len(seq) + n, e) for sid, seq in data.items() for n, e in enumerate(seq)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "sequence_id string, position long, items array<string>")
    want = brute(list(data.values()), min_count(0.3, len(data)), 4)
    assert found(patterns.ALGORITHMS[name](df, 0.3, max_items=4)) == want
    short = {p: n for p, n in want.items() if len(p) <= 2}
    assert found(patterns.ALGORITHMS[name](df, 0.3, max_items=4, max_elements=2)) == short


@pytest.mark.parametrize("name", ["prefixspan", "spade", "cm_spade"])
def test_packed_and_long_sequences_add_up(spark, monkeypatch, name):
    data = _random(53, 20) | {f"long{i}": [["a"], ["b", "c"], ["d"]] * 30 for i in range(6)}
    want = brute(list(data.values()), min_count(0.4, len(data)), 3)
    assert found(patterns.ALGORITHMS[name](elements(spark, data), 0.4, max_items=3)) == want
    monkeypatch.setattr(patterns, "PACKED_ITEMS", 2)
    assert found(patterns.ALGORITHMS[name](elements(spark, data), 0.4, max_items=3)) == want


def test_given_patterns_of_short_sequences_are_matched_row_by_row(spark, monkeypatch):
    data = _random(59, 20)
    given = {"ab": [["a"], ["b"]], "abc": [["a", "b"], ["c"]], "aba": [["a"], ["b"], ["a"]], "d": [["d"]], "z": [["a"], ["z"]]}
    table = spark.createDataFrame(list(given.items()), "pattern string, elements array<array<string>>")
    want = sorted((p, sid) for p, e in given.items() for sid, seq in data.items() if contains(e, seq))
    with monkeypatch.context() as m:
        m.setattr(patterns, "_step", None)
        assert sorted(map(tuple, patterns.match_patterns(elements(spark, data), table).collect())) == want
    data |= {"long": [["a"], ["b", "c"]] * 40}
    want += [(p, "long") for p, e in given.items() if contains(e, data["long"])]
    assert sorted(map(tuple, patterns.match_patterns(elements(spark, data), table).collect())) == sorted(want)


def test_spade_with_a_million_events_in_one_sequence(spark):
    events = spark.range(1_000_000).select(F.lit("hot").alias("sequence_id"), (F.col("id") + 1).alias("position"), F.array(F.concat(F.lit("i"), F.col("id") % 5)).alias("items"))
    short = {f"s{i}": [["i0"], ["i1"], ["i0"], ["i9"]] for i in range(3)}
    got = found(patterns.spade(events.unionByName(elements(spark, short)), 1.0, max_items=3))
    assert got == {p: 4 for p in brute([[["i0"], ["i1"], ["i0"]]], 1, 3)}


def test_a_step_meets_one_chunk(spark, monkeypatch):
    monkeypatch.setattr(patterns, "CHUNK", 4)
    at = {x: [n for n in range(200) if n % k == 0] for x, k in (("a", 3), ("b", 7))}
    rows = [("s", x, p // 4, p) for x, ps in at.items() for p in ps]
    chunks = spark.createDataFrame(rows, "sequence_id string, x string, chunk long, p long").groupBy("sequence_id", "x", "chunk").agg(
        F.sort_array(F.collect_list("p")).alias("positions")
    )
    states = spark.range(-1, 200).select(F.lit("s").alias("sequence_id"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("x"), F.col("id").alias("f"), "id")
    got = [(r.x, r.id, r.f) for r in patterns._step(states, patterns._spans(chunks)).collect()]
    want = [(x, f, min(p for p in ps if p > f)) for x, ps in at.items() for f in range(-1, 200) if f < ps[-1]]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("chunk", [1024, 3])
def test_covered_sequences_leave_once(spark, monkeypatch, chunk):
    monkeypatch.setattr(patterns, "CHUNK", chunk)
    data = _random(51, 50)
    given = [[["a", "b", "c"]], [["d"], ["d"]], [["b"], ["a", "c"], ["d"]], [["a"], ["b"], ["c"], ["d"]], [["zz"], ["a"]]]
    table = spark.createDataFrame([(str(n), p) for n, p in enumerate(given)], "pattern string, elements array<array<string>>")
    want = sorted(k for k, s in data.items() if any(contains(p, s) for p in given))
    assert 0 < len(want) < 50
    for got in (patterns.matching_sequences(elements(spark, data), table), evaluate._covered_sequences(elements(spark, data), table)):
        assert sorted(r.sequence_id for r in got.collect()) == want
    with_single = table.unionByName(spark.createDataFrame([("one", [["a"]])], table.schema))
    want = sorted(k for k, s in data.items() if any(contains(p, s) for p in [*given, [["a"]]]))
    assert sorted(r.sequence_id for r in evaluate._covered_sequences(elements(spark, data), with_single).collect()) == want
    assert patterns.matching_sequences(elements(spark, data), table.limit(0)).count() == 0


def test_prefixspan_repeated_items_in_an_element(spark):
    df = elements(spark, {"s1": [["a", "a", "b"], ["b"]], "s2": [["b", "a"], ["a", "b"]]})
    want = brute([[["a", "b"], ["b"]], [["a", "b"], ["a", "b"]]], 2, 3)
    assert found(patterns.prefixspan(df, 1.0, max_items=3)) == want


def test_prefixspan_with_a_million_events_in_one_sequence(spark):
    events = spark.range(1_000_000).select(F.lit("hot").alias("sequence_id"), (F.col("id") + 1).alias("position"), F.array(F.concat(F.lit("i"), F.col("id") % 5)).alias("items"))
    short = {f"s{i}": [["i0"], ["i1"], ["i0"], ["i9"]] for i in range(3)}
    got = found(patterns.prefixspan(events.unionByName(elements(spark, short)), 1.0, max_items=3))
    assert got == {p: 4 for p in brute([[["i0"], ["i1"], ["i0"]]], 1, 3)}


def test_every_sequence_holds_the_empty_pattern(spark):
    df = elements(spark, {"s1": [["a"]], "s2": [["b"], ["a"]]})
    given = spark.createDataFrame([("none", []), ("ba", [["b"], ["a"]]), ("z", [["z"]])], "pattern string, elements array<array<string>>")
    assert {r["pattern"]: r["support_count"] for r in patterns.count_patterns(df, given).collect()} == {"none": 2, "ba": 1, "z": 0}


def test_marks_in_items_do_not_join_patterns(spark):
    df = elements(spark, {"s1": [["a|b"]], "s2": [["a", "b"]], "s3": [["a>b"]], "s4": [["a"], ["b"]], "s5": [["c"]]})
    given = spark.createDataFrame([([["a|b"]],), ([["a", "b"]],), ([["a>b"]],), ([["a"], ["b"]],)], "elements array<array<string>>")
    assert evaluate._covered_sequences(df, given).count() == 4
    keys = given.select(pattern_key("elements").alias("k")).distinct().count()
    assert keys == 4


def test_unbounded_length(spark):
    data = {f"s{n}": [["a"], ["b"], ["a"], ["c"], ["a", "b"]] for n in range(4)}
    want = brute(list(data.values()), 4, 6)
    for mine in patterns.ALGORITHMS.values():
        assert found(mine(elements(spark, data), 1.0)) == want


def test_containment(spark):
    cases = [
        ([["a"], ["b"]], [["a", "b"]], False),
        ([["a", "c"], ["a", "b"]], [["a"], ["b"]], True),
        ([["a", "c"], ["a", "b"]], [["a", "b"]], True),
        ([["a"]], [["a"], ["a"]], False),
    ]
    df = spark.createDataFrame(cases, "seq array<array<string>>, pat array<array<string>>, want boolean")
    got = df.select(contains_pattern(F.col("seq"), F.col("pat")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


@pytest.mark.parametrize("chunk", [1024, 3])
def test_count_patterns(spark, monkeypatch, chunk):
    monkeypatch.setattr(patterns, "CHUNK", chunk)
    data = _random(33, 40)
    given = [
        [["a"]], [["a", "b"]], [["b"], ["a"]], [["a"], ["a", "c"], ["d"]], [["a", "b"], ["c"]],
        [["d"], ["d"], ["d"], ["d"]], [["zz"]], [["a"], ["zz"]],
    ]
    table = spark.createDataFrame([(str(n), p) for n, p in enumerate(given)], "pattern string, elements array<array<string>>")
    got = {int(r.pattern): r.support_count for r in patterns.count_patterns(elements(spark, data), table).collect()}
    assert got == {n: sum(contains(p, s) for s in data.values()) for n, p in enumerate(given)}


def test_nothing_frequent(spark):
    data = {"x": [["a"]], "y": [["b"]], "z": [["c"]]}
    for mine in patterns.ALGORITHMS.values():
        assert mine(elements(spark, data), 0.9).count() == 0
        assert mine(elements(spark, {}), 0.9).count() == 0


def test_infinite_lift_when_consequent_is_unknown(spark):
    table = spark.createDataFrame(
        [([["a"]], 1, 1, 2, 0.5), ([["a"], ["b"]], 2, 2, 1, 0.25)],
        "elements array<array<string>>, n_elements int, n_items int, support_count long, support double",
    )
    got = rules.sequential_rules(table, 0.5)
    assert got.first().lift == float("inf")
    quality = evaluate.sequence_rule_quality(table, got).first()
    assert (quality.avg_lift, quality.num_high_lift_rules) == (0.0, 1)


@pytest.mark.parametrize("name", ["prefixspan", "spade", "cm_spade", "gsp"])
def test_last_level_is_counted_without_being_laid_out(spark, monkeypatch, name):
    """Classes, projections and states that only the last level reads are not written; one pass over the elements."""
    written, write = [], patterns.durable
    monkeypatch.setattr(patterns, "durable", lambda df: written.append(df.columns) or write(df))
    monkeypatch.setattr(patterns, "encode", None)
    data = {"s0": [["a", "b"], ["c"], ["a"], ["b", "c"]], "s1": [["a"], ["b", "c"], ["a", "b"]], "s2": [["c"], ["a", "c"], ["b"]]}
    want = brute(list(data.values()), min_count(0.6, 3), 3)
    assert any(sum(map(len, p)) == 3 for p in want)
    assert found(patterns.ALGORITHMS[name](elements(spark, data), 0.6, max_items=3)) == want
    laid_out = [c for c in written if {"members", "states"} & set(c)]
    # GSP's rows get the frequent pairs of one element
    assert len(laid_out) <= (name == "gsp")


@pytest.mark.parametrize("longest", [3, 4, 5])
def test_gsp_counts_short_sequences_row_by_row(spark, monkeypatch, longest):
    """No occurrences or rows of match states, up to the last position of a block, with repeated elements."""
    for other in ("_item_occurrences", "_first_states", "_last_ends", "_count_after", "_advance", "_intersect", "_step"):
        monkeypatch.setattr(patterns, other, None)
    data = _random(53, 30)
    rows = [(sid, 64 - len(seq) + n, e) for sid, seq in data.items() for n, e in enumerate(seq)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "sequence_id string, position long, items array<string>")
    want = brute(list(data.values()), min_count(0.1, len(data)), longest)
    assert any(sum(map(len, p)) == longest for p in want)
    assert found(patterns.gsp(df, 0.1, max_items=longest)) == want


@pytest.mark.parametrize("name", ["prefixspan", "spade", "cm_spade", "gsp"])
def test_short_and_long_sequences_and_sequences_without_items(spark, name):
    rng = random.Random(59)
    data = {f"s{s}": [sorted(rng.sample("abcd", rng.randint(1, 3))) for _ in range(rng.randint(1, 5))] for s in range(20)}
    for n in range(8):
        data[f"long{n}"] = [sorted(rng.sample("abcd", rng.randint(1, 2))) for _ in range(90)]
    rows = [(sid, n + 1, e) for sid, seq in data.items() for n, e in enumerate(seq)]
    rows += [(f"none{n}", 1, []) for n in range(12)]
    df = spark.createDataFrame(rows, "sequence_id string, position long, items array<string>")
    want = brute(list(data.values()), min_count(0.4, 40), 4)
    out = patterns.ALGORITHMS[name](df, 0.4, max_items=4)
    assert found(out) == want
    assert out.where("n_items = 1 AND elements[0][0] = 'a'").first()["support"] == want[("a",),] / 40
