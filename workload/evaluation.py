"""Evaluator queries."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from weft.functions import itemset_key
from weft.operators import evaluate, itemsets, patterns, rules
from weft.plans import report
from weft.runtime import cached, durable

from . import data, sql
from .mining import BRAND, PRIORITY, PURCHASE, TYPE, brand_rules, purchase_rules, type_rules
from .registry import query

_TYPE = f"WITH {sql.itemsets('type', TYPE, 6)}, {sql.rules('confidence >= 0.4')}"
_TYPE_WIDE = f"WITH {sql.itemsets('type', TYPE, 6)}, {sql.rules('confidence >= 0.1')}"
_BRAND = f"WITH {sql.itemsets('brand', BRAND, 4)}, {sql.rules('confidence >= 0.15')}"


def _coverage(ctes: str, sets: str) -> str:
    """Coverage by definition: some listed set is a subset of the basket."""
    return f"""{ctes},
    b AS (SELECT tid, list(item) AS basket FROM pairs GROUP BY tid),
    hit AS (SELECT
        (SELECT count(*) FROM b WHERE EXISTS (SELECT 1 FROM {sets} s WHERE list_has_all(b.basket, s.items))) AS by_sets,
        (SELECT count(*) FROM b WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT antecedent FROM rules) r
            WHERE list_has_all(b.basket, r.antecedent))) AS by_rules),
    t AS (SELECT (SELECT count(*) FROM b) AS total_transactions, (SELECT count(DISTINCT item) FROM pairs) AS total_items,
        (SELECT count(DISTINCT i) FROM (SELECT unnest(items) AS i FROM {sets})) AS covered_items, by_sets, by_rules FROM hit)
    SELECT total_transactions, total_items, covered_items, by_sets AS transactions_with_itemsets, by_rules AS transactions_with_rules,
        round(covered_items / total_items, 6) AS item_coverage, round(by_sets / total_transactions, 6) AS transaction_coverage,
        round(by_rules / total_transactions, 6) AS rule_coverage FROM t"""


@query("fp_coverage", _coverage(_BRAND, "itemsets"))
def fp_coverage(spark, sf):
    with cached(data.brand_baskets(spark, sf)) as b:
        found = durable(itemsets.fpgrowth(b, BRAND))
        return evaluate.coverage(b, found, rules.association_rules(found, "confidence", 0.15))


@query("fp_coverage_pairs_only", _coverage(_BRAND, "(SELECT * FROM itemsets WHERE size >= 2)"))
def fp_coverage_pairs_only(spark, sf):
    with cached(data.brand_baskets(spark, sf)) as b:
        found = durable(itemsets.fpgrowth(b, BRAND))
        return evaluate.coverage(b, report.at_least(found, 2), rules.association_rules(found, "confidence", 0.15))


_QUALITY = """SELECT count(*) AS total_rules, round(avg(confidence), 6) AS avg_confidence, round(avg(lift), 6) AS avg_lift,
    round(avg(support), 6) AS avg_support, count(*) FILTER (confidence >= {c}) AS num_high_confidence_rules,
    count(*) FILTER (lift >= {l}) AS num_high_lift_rules, round(stddev_samp(confidence), 6) AS std_confidence,
    round(stddev_samp(lift), 6) AS std_lift,
    round((count(*) - count(DISTINCT array_to_string(consequent, '|'))) / count(*), 6) AS redundancy_ratio FROM rules"""


@query("rule_quality", _TYPE + " " + _QUALITY.format(c=0.8, l=2.0))
def rule_quality(spark, sf):
    return evaluate.rule_quality(type_rules(spark, sf))


@query("rule_quality_thresholds", _TYPE + " " + _QUALITY.format(c=0.45, l=1.0))
def rule_quality_thresholds(spark, sf):
    return evaluate.rule_quality(type_rules(spark, sf), high_confidence=0.45, high_lift=1.0)


def _bucketed(ctes: str, column: str, buckets, table: str = "rules") -> str:
    rows = " UNION ALL ".join(f"SELECT '{label}' AS bucket, {lo} AS lo, {hi} AS hi" for label, lo, hi in buckets)
    return f"""{ctes}, buckets AS ({rows})
    SELECT bucket, count(r.{column}) AS n FROM buckets LEFT JOIN {table} r ON r.{column} >= lo AND r.{column} < hi GROUP BY bucket"""


_FIFTHS = [("0.0-0.2", -1e9, 0.2), ("0.2-0.4", 0.2, 0.4), ("0.4-0.6", 0.4, 0.6), ("0.6-0.8", 0.6, 0.8), ("0.8-1.0", 0.8, 1e9)]
_LIFTS = [("<1.0", -1e9, 1.0), ("1.0-2.0", 1.0, 2.0), ("2.0-5.0", 2.0, 5.0), (">5.0", 5.0, 1e9)]


@query("confidence_histogram", _bucketed(_TYPE_WIDE, "confidence", _FIFTHS))
def confidence_histogram(spark, sf):
    return evaluate.confidence_histogram(type_rules(spark, sf, bound=0.1))


@query("lift_histogram", _bucketed(_TYPE_WIDE, "lift", _LIFTS))
def lift_histogram(spark, sf):
    return evaluate.lift_histogram(type_rules(spark, sf, bound=0.1))


@query(
    "itemset_sizes",
    f"""WITH {sql.itemsets('type', TYPE, 6)}, i AS (SELECT unnest(items) AS item FROM itemsets)
    SELECT count(*) AS total_itemsets, round(avg(size), 6) AS avg_itemset_size, max(size) AS max_itemset_size,
    (SELECT count(DISTINCT item) FROM i) AS unique_items, (SELECT count(*) FROM i) AS total_elements,
    round((SELECT count(DISTINCT item) / count(*) FROM i), 6) AS memory_efficiency FROM itemsets""",
)
def itemset_sizes(spark, sf):
    return evaluate.itemset_shape(itemsets.fpgrowth(data.type_baskets(spark, sf), TYPE))


@query(
    "itemset_size_distribution",
    f"WITH {sql.itemsets('type', TYPE, 6)} SELECT size, count(*) AS n FROM itemsets GROUP BY size",
)
def itemset_size_distribution(spark, sf):
    return evaluate.size_distribution(itemsets.fpgrowth(data.type_baskets(spark, sf), TYPE))


def _profile(spark, figures):
    """Times differ from run to run; rates times seconds are the counts, and are shown."""
    seconds = figures.pop("execution_time")
    counts = {k.removesuffix("_per_second"): round(v * seconds) for k, v in figures.items()}
    schema = ", ".join(f"{k} bigint" for k in counts)
    return spark.createDataFrame([(*counts.values(), seconds > 0)], f"{schema}, timed boolean")


@query("fp_run_profile", f"WITH {sql.itemsets('brand', BRAND, 4)}, {sql.rules('confidence >= 0.15')} SELECT (SELECT count(*) FROM itemsets) AS itemsets, (SELECT count(*) FROM rules) AS rules, n AS transactions, TRUE AS timed FROM n")
def fp_run_profile(spark, sf):
    b = data.brand_baskets(spark, sf)
    began = time.perf_counter()
    found = durable(itemsets.fpgrowth(b, BRAND))
    n_rules = rules.association_rules(found, "confidence", 0.15).count()
    return _profile(spark, evaluate.run_profile(time.perf_counter() - began, b.count(), found.count(), n_rules))


def _summary() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, count({m}) AS n, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS std, "
        f"round(min({m}), 6) AS min, round(max({m}), 6) AS max FROM rules"
        for m in evaluate.RULE_METRICS
    )
    return f"{_TYPE_WIDE} {rows}"


@query("rule_metric_summary", _summary())
def rule_metric_summary(spark, sf):
    return evaluate.rule_metric_summary(type_rules(spark, sf, bound=0.1))


@query(
    "rule_counts",
    f"""{_TYPE} SELECT count(*) AS n_rules, count(*) FILTER (confidence >= 0.8) AS n_high_confidence,
    count(*) FILTER (lift >= 2.0) AS n_high_lift, count(*) FILTER (lift > 1) AS n_lift_above_1,
    round(100.0 * count(*) FILTER (lift > 1) / count(*), 6) AS percent_lift_above_1 FROM rules""",
)
def rule_counts(spark, sf):
    return evaluate.rule_counts(type_rules(spark, sf))


def _bins(ctes: str, expr: str, table: str, bins: int) -> str:
    return f"""{ctes} v AS (SELECT CAST({expr} AS DOUBLE) AS v FROM {table}), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
    p AS (SELECT least(CAST(floor((v - lo) / ((hi - lo) / {bins})) AS INTEGER) + 1, {bins}) AS bin FROM v, e)
    SELECT b AS bin, count(p.bin) AS n FROM generate_series(1, {bins}) g(b) LEFT JOIN p ON p.bin = b GROUP BY b"""


@query("metric_histogram", _bins(f"WITH {sql.itemsets('type', TYPE, 6)},", "support_count", "itemsets", 20))
def metric_histogram(spark, sf):
    return evaluate.histogram(itemsets.fpgrowth(data.type_baskets(spark, sf), TYPE), "support_count", 20)


@query(
    "length_histogram",
    _bins("WITH", "l", f"(SELECT sid, count(DISTINCT pos) AS l FROM ({sql.ELEMENTS['event']}) GROUP BY sid)", 30),
)
def length_histogram(spark, sf):
    lengths = data.event_sequences(spark, sf).groupBy("sequence_id").agg(F.count("position").alias("length"))
    return evaluate.histogram(lengths, "length", 30)


@query(
    "lift_pivot",
    f"""{_BRAND}, top AS (SELECT {sql.text('antecedent')} AS antecedent, {sql.text('consequent')} AS consequent, lift FROM rules
      ORDER BY lift DESC, 1, 2 LIMIT 50)
    SELECT antecedent, consequent, round(avg(lift), 6) AS mean_lift FROM top GROUP BY ALL""",
)
def lift_pivot(spark, sf):
    return evaluate.lift_pivot(report.top_rules(brand_rules(spark, sf), 50, by="lift"))


# two closed consequents of the wide shape, fixed values
_PIVOT = ["LARGE", "PROMO"]


@query(
    "lift_pivot_wide",
    f"""{_TYPE_WIDE}, top AS (SELECT {sql.text('antecedent')} AS antecedent, {sql.text('consequent')} AS consequent, lift FROM rules
      ORDER BY lift DESC, 1, 2 LIMIT 50)
    SELECT antecedent, """
    + ", ".join(f"round(avg(lift) FILTER (consequent = '{c}'), 6) AS \"{c}\"" for c in _PIVOT)
    + " FROM top GROUP BY antecedent",
)
def lift_pivot_wide(spark, sf):
    top = report.top_rules(type_rules(spark, sf, bound=0.1), 50, by="lift")
    texts = top.select(itemset_key("antecedent").alias("antecedent"), itemset_key("consequent").alias("consequent"), "lift")
    return evaluate.lift_pivot_wide(texts, _PIVOT)


# -- sequential -----------------------------------------------------------------------------------

_PURCHASE = f"WITH {sql.patterns('purchase', PURCHASE)}, {sql.sequence_rules(0.8)}"
_PRIORITY = f"WITH {sql.patterns('priority', PRIORITY)}"


@query(
    "sp_coverage",
    f"""{_PURCHASE}, parts AS (SELECT unnest(string_split(key, '>')) AS e FROM patterns),
    t AS (SELECT (SELECT n FROM n) AS total_sequences, (SELECT count(DISTINCT item) FROM elems) AS total_items,
      (SELECT count(DISTINCT i) FROM (SELECT unnest(string_split(e, '|')) AS i FROM parts)) AS covered_items,
      (SELECT count(DISTINCT e) FROM parts) AS unique_pattern_elements, (SELECT count(*) FROM parts) AS total_pattern_elements,
      (SELECT count(DISTINCT sid) FROM held WHERE key IN (SELECT key FROM patterns)) AS sequences_matched,
      (SELECT count(DISTINCT sid) FROM held WHERE key IN (SELECT antecedent FROM srules)) AS sequences_with_rules)
    SELECT *, round(covered_items / total_items, 6) AS item_coverage, round(sequences_matched / total_sequences, 6) AS sequence_coverage,
      round(unique_pattern_elements / total_pattern_elements, 6) AS pattern_diversity,
      round(sequences_with_rules / total_sequences, 6) AS rule_coverage FROM t""",
)
def sp_coverage(spark, sf):
    with cached(data.purchase_sequences(spark, sf)) as elements:
        found = durable(patterns.prefixspan(elements, PURCHASE, max_items=3))
        return evaluate.sequence_coverage(elements, found, rules.sequential_rules(found, 0.8))


@query(
    "sp_coverage_long_patterns",
    f"""WITH {sql.patterns('purchase', PURCHASE)}
    SELECT count(DISTINCT sid) AS sequences_matched FROM held
    WHERE key IN (SELECT key FROM patterns WHERE n_elements = 2 AND n_items = 3)""",
)
def sp_coverage_long_patterns(spark, sf):
    with cached(data.purchase_sequences(spark, sf)) as elements:
        found = durable(patterns.prefixspan(elements, PURCHASE, max_items=3).where("n_elements = 2 AND n_items = 3"))
        matched = patterns.match_patterns(elements, found.withColumn("pattern", F.col("elements").cast("string")))
        return durable(matched.agg(F.countDistinct("sequence_id").alias("sequences_matched")))


@query(
    "sp_rule_quality",
    f"""{_PURCHASE} SELECT (SELECT count(*) FROM patterns) AS total_patterns,
    round((SELECT avg(n_elements) FROM patterns), 6) AS avg_pattern_length, (SELECT max(n_elements) FROM patterns) AS max_pattern_length,
    count(*) AS total_rules, round(avg(confidence), 6) AS avg_confidence, round(avg(lift), 6) AS avg_lift, round(avg(support), 6) AS avg_support,
    count(*) FILTER (confidence >= 0.8) AS num_high_confidence_rules, count(*) FILTER (lift >= 2.0) AS num_high_lift_rules,
    round(stddev_samp(confidence), 6) AS std_confidence FROM srules""",
)
def sp_rule_quality(spark, sf):
    return evaluate.sequence_rule_quality(*purchase_rules(spark, sf))


@query(
    "pattern_lengths",
    f"{_PRIORITY} SELECT n_elements, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM patterns), 6) AS percent "
    "FROM patterns GROUP BY n_elements",
)
def pattern_lengths(spark, sf):
    return evaluate.pattern_lengths(patterns.prefixspan(data.priority_sequences(spark, sf), PRIORITY, max_items=3))


@query(
    "pattern_length_share",
    f"WITH {sql.patterns('purchase', PURCHASE)} SELECT n_elements, count(*) AS n, "
    "round(100.0 * count(*) / (SELECT count(*) FROM patterns), 6) AS percent FROM patterns GROUP BY n_elements",
)
def pattern_length_share(spark, sf):
    return evaluate.pattern_lengths(patterns.spade(data.purchase_sequences(spark, sf), PURCHASE, max_items=3))


@query("sp_confidence_histogram", _bucketed(_PURCHASE, "confidence", _FIFTHS, "srules"))
def sp_confidence_histogram(spark, sf):
    return evaluate.confidence_histogram(purchase_rules(spark, sf)[1])


@query(
    "sp_data_profile",
    f"""WITH {sql.patterns('purchase', PURCHASE)}, s AS (SELECT sid, count(DISTINCT pos) AS l, count(*) AS i FROM elems GROUP BY sid)
    SELECT count(*) AS total_sequences, round(avg(l), 6) AS avg_sequence_length, max(l) AS max_sequence_length,
    CAST(sum(i) AS BIGINT) AS total_items_in_sequences, round(sum(i) / count(*), 6) AS items_per_sequence,
    round((SELECT avg(n_elements) FROM patterns), 6) AS avg_pattern_size FROM s""",
)
def sp_data_profile(spark, sf):
    elements = data.purchase_sequences(spark, sf)
    return evaluate.sequence_profile(elements, patterns.prefixspan(elements, PURCHASE, max_items=3))


@query("sp_run_profile", f"WITH {sql.patterns('priority', PRIORITY)}, {sql.sequence_rules(0.5)} SELECT (SELECT count(*) FROM patterns) AS patterns, (SELECT count(*) FROM srules) AS rules, n AS sequences, TRUE AS timed FROM n")
def sp_run_profile(spark, sf):
    elements = data.priority_sequences(spark, sf)
    began = time.perf_counter()
    found = durable(patterns.prefixspan(elements, PRIORITY, max_items=3))
    n_rules = rules.sequential_rules(found, 0.5).count()
    seconds = time.perf_counter() - began
    n = elements.select("sequence_id").distinct().count()
    return _profile(spark, evaluate.run_profile(seconds, n, found.count(), n_rules, "patterns", "sequences"))
