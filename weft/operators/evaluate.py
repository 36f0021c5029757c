"""Evaluators: coverage, rule quality, sizes, profiles and histograms.

Each returns a small table. Bucket tables always list every bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pattern_key
from ..runtime import cached, durable, small_side, with_rarest_item
from .baskets import explode_items as basket_items
from .patterns import matching_sequences
from .sequences import explode_items as sequence_items

# Fixed bucket edges of the two rule histograms.
CONFIDENCE_EDGES = (("0.0-0.2", 0.2), ("0.2-0.4", 0.4), ("0.4-0.6", 0.6), ("0.6-0.8", 0.8), ("0.8-1.0", None))
LIFT_EDGES = (("<1.0", 1.0), ("1.0-2.0", 2.0), ("2.0-5.0", 5.0), (">5.0", None))
RULE_METRICS = ("support", "confidence", "lift", "conviction", "leverage")


def _finite(name: str) -> Column:
    return F.when(F.abs(F.col(name)) < float("inf"), F.col(name))


def _mean(value) -> Column:
    return F.coalesce(F.avg(value), F.lit(0.0))


def _spread(name: str) -> Column:
    return F.coalesce(F.stddev_samp(name), F.lit(0.0))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side, without a join."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def _below(df: DataFrame, column: str, edges) -> DataFrame:
    """Counts per half-open bucket in one pass; the last bucket is open above."""
    name = F.lit(None).cast("string")
    for label, top in reversed(edges):
        name = F.lit(label) if top is None else F.when(F.col(column) < top, label).otherwise(name)
    counts = df.agg(*[F.count_if(name == label).alias(f"n{i}") for i, (label, _) in enumerate(edges)])
    rows = F.array(*[F.struct(F.lit(label).alias("bucket"), F.col(f"n{i}").alias("n")) for i, (label, _) in enumerate(edges)])
    return counts.select(F.inline(rows))


# -- itemsets and association rules ---------------------------------------------------------------


def _covered_baskets(baskets: DataFrame, sets: DataFrame) -> DataFrame:
    """Tids of baskets that contain at least one set.

    A set with an item that is itself a listed single adds nothing, so with a
    complete itemset table only the singles remain. Baskets with one of those
    leave. The other sets are looked up through their rarest item and tested
    whole, until the first one fits: no (set, basket) pairs are put out.
    """
    distinct = durable(sets.select(F.sort_array("items").alias("items")).distinct())
    singles = distinct.where(F.size("items") == 1).select(F.get("items", F.lit(0)).alias("item"))
    n_singles = singles.count()
    longer = distinct.where(F.size("items") > 1)
    implied = (
        longer.select("items", F.explode("items").alias("item"))
        .join(small_side(singles, n_singles), "item", "left_semi")
        .select("items")
        .distinct()
    )
    rest = durable(longer.join(implied, "items", "left_anti"))
    n_rest = rest.count()
    hits = basket_items(baskets).join(small_side(singles, n_singles), "item", "left_semi").select("tid").distinct()
    if n_rest == 0:
        return hits
    hits = durable(hits)
    anchored = with_rarest_item(rest, basket_items(baskets)).select(F.col("item").alias("anchor"), F.col("items").alias("wanted"))
    open_baskets = baskets.join(hits, "tid", "left_anti").select("tid", "items", F.explode("items").alias("item"))
    holds = (F.col("item") == F.col("anchor")) & (F.size(F.array_except("wanted", "items")) == 0)
    return hits.unionByName(open_baskets.join(small_side(anchored, n_rest), holds, "left_semi").select("tid").distinct())


def coverage(baskets: DataFrame, itemsets: DataFrame, rules: DataFrame) -> DataFrame:
    """Item, basket and rule coverage with the counts behind them."""
    covered = itemsets.select(F.explode("items").alias("item")).agg(F.countDistinct("item").alias("covered_items"))
    antecedents = rules.select(F.col("antecedent").alias("items"))
    n = F.col("total_transactions")
    with cached(baskets) as held:
        kinds = durable(held.groupBy("items").agg(F.count(F.lit(1)).alias("n"))).withColumn("tid", F.monotonically_increasing_id())
        totals = kinds.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"))
        vocabulary = basket_items(kinds).agg(F.countDistinct("item").alias("total_items"))
        whole = held.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("tid").alias("tids")).first()

        def covering(sets: DataFrame, name: str) -> DataFrame:
            # a tid of several rows counts once, so such baskets are looked at one by one
            if whole["n"] != whole["tids"]:
                return _covered_baskets(held, sets).agg(F.count(F.lit(1)).alias(name))
            covered_kinds = _covered_baskets(kinds, sets).join(kinds.select("tid", "n"), "tid")
            return covered_kinds.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))

        by_sets = covering(itemsets, "transactions_with_itemsets")
        by_rules = covering(antecedents, "transactions_with_rules")
        row = _one_row(totals, vocabulary, covered, by_sets, by_rules)
        return durable(
            row.select(
                "*",
                _share(F.col("covered_items"), F.col("total_items")).alias("item_coverage"),
                _share(F.col("transactions_with_itemsets"), n).alias("transaction_coverage"),
                _share(F.col("transactions_with_rules"), n).alias("rule_coverage"),
            )
        )


def rule_quality(rules: DataFrame, high_confidence: float = 0.8, high_lift: float = 2.0) -> DataFrame:
    """Averages, high counts, redundancy and deviations; zeros when there are no rules."""
    per_consequent = rules.groupBy("consequent").agg(F.count(F.lit(1)).alias("_n"))
    redundancy = per_consequent.agg(
        _share(F.sum(F.col("_n") - 1), F.sum("_n")).alias("redundancy_ratio")
    )
    figures = rules.agg(
        F.count(F.lit(1)).alias("total_rules"),
        _mean("confidence").alias("avg_confidence"),
        _mean("lift").alias("avg_lift"),
        _mean("support").alias("avg_support"),
        F.count_if(F.col("confidence") >= high_confidence).alias("num_high_confidence_rules"),
        F.count_if(F.col("lift") >= high_lift).alias("num_high_lift_rules"),
        _spread("confidence").alias("std_confidence"),
        _spread("lift").alias("std_lift"),
    )
    return _one_row(figures, redundancy)


def confidence_histogram(rules: DataFrame) -> DataFrame:
    return _below(rules, "confidence", CONFIDENCE_EDGES)


def lift_histogram(rules: DataFrame) -> DataFrame:
    return _below(rules, "lift", LIFT_EDGES)


def itemset_shape(itemsets: DataFrame) -> DataFrame:
    """Average and largest size, and distinct items per item slot."""
    sizes = itemsets.agg(
        F.count(F.lit(1)).alias("total_itemsets"),
        _mean("size").alias("avg_itemset_size"),
        F.coalesce(F.max("size"), F.lit(0)).alias("max_itemset_size"),
    )
    slots = itemsets.select(F.explode("items").alias("item")).agg(
        F.countDistinct("item").alias("unique_items"), F.count("item").alias("total_elements")
    )
    return _one_row(sizes, slots).withColumn(
        "memory_efficiency", _share(F.col("unique_items"), F.col("total_elements"))
    )


def size_distribution(itemsets: DataFrame) -> DataFrame:
    return itemsets.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


def run_profile(
    seconds: float, n_rows: int, n_found: int, n_rules: int, found: str = "itemsets", rows: str = "transactions"
) -> dict[str, float]:
    """Rates of one timed run; 0 when no time passed."""
    rate = (lambda n: n / seconds) if seconds > 0 else (lambda n: 0.0)
    return {
        "execution_time": float(seconds),
        f"{found}_per_second": rate(n_found),
        "rules_per_second": rate(n_rules),
        f"{rows}_per_second": rate(n_rows),
    }


def rule_metric_summary(rules: DataFrame) -> DataFrame:
    """Mean, deviation, extremes of the five measures, infinities left out."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), _finite(m).alias("value")) for m in RULE_METRICS])
    return (
        rules.select(F.inline(pairs))
        .where("value IS NOT NULL")
        .groupBy("metric")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )


def rule_counts(rules: DataFrame, high_confidence: float = 0.8, high_lift: float = 2.0) -> DataFrame:
    """Rules of high confidence, of high lift, and above lift 1 with their percentage."""
    positive = F.count_if(F.col("lift") > 1)
    return rules.agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.count_if(F.col("confidence") >= high_confidence).alias("n_high_confidence"),
        F.count_if(F.col("lift") >= high_lift).alias("n_high_lift"),
        positive.alias("n_lift_above_1"),
        (100.0 * _share(positive, F.count(F.lit(1)))).alias("percent_lift_above_1"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest finite value; the top edge belongs to the last bin."""
    values = df.select(_finite(column).cast("double").alias("v")).where("v IS NOT NULL")
    edges = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")))
    span = F.col("e.hi") - F.col("e.lo")
    placed = values.select("v", edges.scalar().alias("e")).select(
        F.when(span == 0, F.lit(1))
        .otherwise(F.least(F.expr(f"cast(width_bucket(v, e.lo, e.hi, {bins}) AS int)"), F.lit(bins)))
        .alias("bin"),
        "e",
    )
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("e").alias("e"))
    filled = counted.select(F.col("bin"), "n").unionByName(
        edges.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), F.lit(0).cast("bigint").alias("n"))
    )
    return filled.groupBy("bin").agg(F.sum("n").alias("n"))


def lift_pivot(top_rules: DataFrame) -> DataFrame:
    """Mean lift per antecedent and consequent, long shape."""
    return top_rules.groupBy("antecedent", "consequent").agg(F.avg("lift").alias("mean_lift"))


def lift_pivot_wide(top_rules: DataFrame, consequents: list[str]) -> DataFrame:
    """Mean lift with one column per consequent of a closed list; sides as text."""
    return top_rules.groupBy("antecedent").pivot("consequent", consequents).agg(F.avg("lift"))


# -- sequential patterns and rules ----------------------------------------------------------------


def _covered_sequences(elements: DataFrame, patterns: DataFrame) -> DataFrame:
    """Sequences that contain at least one pattern; patterns implied by a listed single item are skipped."""
    keyed = durable(patterns.select(pattern_key("elements").alias("pattern"), "elements").dropDuplicates(["pattern"]))
    flat = F.flatten("elements")
    singles = keyed.where(F.size(flat) == 1).select(F.get(flat, F.lit(0)).alias("item"))
    n_singles = singles.count()
    longer = keyed.where(F.size(flat) > 1)
    implied = (
        longer.select("pattern", F.explode(flat).alias("item"))
        .join(small_side(singles, n_singles), "item", "left_semi")
        .select("pattern")
        .distinct()
    )
    rest = durable(longer.join(implied, "pattern", "left_anti"))
    hits = sequence_items(elements).join(small_side(singles, n_singles), "item", "left_semi").select("sequence_id").distinct()
    if rest.isEmpty():
        return hits
    hits = durable(hits)
    return hits.unionByName(matching_sequences(elements.join(hits, "sequence_id", "left_anti"), rest))


def sequence_coverage(elements: DataFrame, patterns: DataFrame, rules: DataFrame) -> DataFrame:
    """Item and sequence coverage, pattern diversity and rule coverage."""
    n = F.col("total_sequences")
    covered = patterns.select(F.explode(F.flatten("elements")).alias("item")).agg(
        F.countDistinct("item").alias("covered_items")
    )
    parts = patterns.select(F.explode("elements").alias("e")).agg(
        F.countDistinct(F.sort_array("e")).alias("unique_pattern_elements"),
        F.count("e").alias("total_pattern_elements"),
    )
    antecedents = rules.select(F.col("antecedent").alias("elements"))
    with cached(elements) as held:
        totals = held.agg(F.countDistinct("sequence_id").alias("total_sequences"))
        vocabulary = sequence_items(held).agg(F.countDistinct("item").alias("total_items"))
        matched = _covered_sequences(held, patterns).agg(F.count(F.lit(1)).alias("sequences_matched"))
        by_rules = _covered_sequences(held, antecedents).agg(F.count(F.lit(1)).alias("sequences_with_rules"))
        row = _one_row(totals, vocabulary, covered, parts, matched, by_rules)
        return durable(
            row.select(
                "*",
                _share(F.col("covered_items"), F.col("total_items")).alias("item_coverage"),
                _share(F.col("sequences_matched"), n).alias("sequence_coverage"),
                _share(F.col("unique_pattern_elements"), F.col("total_pattern_elements")).alias("pattern_diversity"),
                _share(F.col("sequences_with_rules"), n).alias("rule_coverage"),
            )
        )


def sequence_rule_quality(
    patterns: DataFrame, rules: DataFrame, high_confidence: float = 0.8, high_lift: float = 2.0
) -> DataFrame:
    """Rule averages (lift without infinities), high counts (infinite lift is high) and pattern lengths."""
    lengths = patterns.agg(
        F.count(F.lit(1)).alias("total_patterns"),
        _mean("n_elements").alias("avg_pattern_length"),
        F.coalesce(F.max("n_elements"), F.lit(0)).alias("max_pattern_length"),
    )
    figures = rules.agg(
        F.count(F.lit(1)).alias("total_rules"),
        _mean("confidence").alias("avg_confidence"),
        _mean(_finite("lift")).alias("avg_lift"),
        _mean("support").alias("avg_support"),
        F.count_if(F.col("confidence") >= high_confidence).alias("num_high_confidence_rules"),
        F.count_if(F.col("lift") >= high_lift).alias("num_high_lift_rules"),
        _spread("confidence").alias("std_confidence"),
    )
    return _one_row(lengths, figures)


def pattern_lengths(patterns: DataFrame) -> DataFrame:
    """Patterns per number of elements, with percentage."""
    counted = patterns.groupBy("n_elements").agg(F.count(F.lit(1)).alias("n"))
    total = patterns.agg(F.count(F.lit(1)))
    return counted.select("n_elements", "n", (100.0 * F.col("n") / total.scalar()).alias("percent"))


def sequence_profile(elements: DataFrame, patterns: DataFrame) -> DataFrame:
    """Sequence length and item figures with the average pattern size."""
    per_sequence = elements.groupBy("sequence_id").agg(
        F.count(F.lit(1)).alias("length"), F.sum(F.size("items")).alias("items")
    )
    data = per_sequence.agg(
        F.count(F.lit(1)).alias("total_sequences"),
        _mean("length").alias("avg_sequence_length"),
        F.coalesce(F.max("length"), F.lit(0)).alias("max_sequence_length"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_items_in_sequences"),
        _share(F.sum("items"), F.count(F.lit(1))).alias("items_per_sequence"),
    )
    sizes = patterns.agg(_mean("n_elements").alias("avg_pattern_size"))
    return _one_row(data, sizes)
