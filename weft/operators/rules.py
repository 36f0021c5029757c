"""Association rules and sequential rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import durable

# 2**12 masks per row at each of the two expansion steps
_LOW_BITS = 12
# A larger itemset has more splits than a table can hold; it is an error, not a shorter result. Rules by confidence have no such bound.
MOST_ITEMS = 40


def _splits(itemsets: DataFrame) -> DataFrame:
    """Every split of an itemset in a non-empty antecedent and a non-empty consequent.

    The bit masks are unfolded in two steps, so no array grows past 2**12 for
    itemsets of up to 24 items. A frequent n-itemset implies 2**n - 1 rows in
    the itemset table itself, so the unfolding stays linear in that table's own growth.
    """
    low = f"least(size, {_LOW_BITS})"
    bounded = F.when(F.col("size") <= MOST_ITEMS, F.col("size")).otherwise(
        F.raise_error(F.concat(F.lit("rules of an itemset of more items than can be split: "), F.col("size").cast("string"))).cast("int")
    )
    masked = (
        itemsets.where("size >= 2").withColumn("size", bounded)
        .withColumn("_hi", F.explode(F.expr(f"sequence(0L, shiftleft(1L, size - {low}) - 1)")))
        .withColumn("_lo", F.explode(F.expr(f"sequence(0L, shiftleft(1L, {low}) - 1)")))
        .withColumn("_m", F.expr(f"shiftleft(_hi, {low}) | _lo"))
        .where("_m > 0 AND _m < shiftleft(1L, size) - 1")
    )

    def bit(i: Column) -> Column:
        return F.call_function("shiftright", F.col("_m"), i).bitwiseAND(F.lit(1).cast("bigint"))

    return masked.select(
        F.filter("items", lambda x, i: bit(i) == 1).alias("antecedent"),
        F.filter("items", lambda x, i: bit(i) == 0).alias("consequent"),
        "support_count",
        "support",
    )


def _confident_splits(itemsets: DataFrame, antecedents: DataFrame, min_confidence: float) -> DataFrame:
    """The splits whose rule reaches ``min_confidence``, consequents grown item by item.

    A rule that misses the bound misses it with every larger consequent of the
    same itemset, as its antecedent only gets more frequent. So a consequent
    is grown only from one that reached it, by items that reached it alone.
    """
    def reaching(tried: DataFrame) -> DataFrame:
        rest = F.filter("items", lambda x: ~F.array_contains("consequent", x))
        scored = tried.withColumn("antecedent", rest).where(F.size("antecedent") > 0).join(antecedents, "antecedent")
        return durable(scored.withColumn("confidence", F.col("support_count") / F.col("_ac")).where(F.col("confidence") >= min_confidence))

    whole = itemsets.where("size >= 2").select("items", "support_count", "support")
    level = reaching(whole.select("*", F.explode(F.transform("items", lambda x: F.array(x))).alias("consequent")))
    found = level
    able = level.groupBy("items").agg(F.array_sort(F.flatten(F.collect_list("consequent"))).alias("able"))
    while level.limit(1).count():
        more = F.explode(F.filter("able", lambda x: x > F.element_at("consequent", -1)))
        grown = level.select("items", "support_count", "support", "consequent").join(able, "items").withColumn("more", more)
        level = reaching(grown.select("items", "support_count", "support", F.concat("consequent", F.array("more")).alias("consequent")))
        found = found.unionByName(level)
    return found.drop("items")


def association_rules(itemsets: DataFrame, metric: str = "confidence", min_threshold: float = 0.5) -> DataFrame:
    """Rules with multi-item sides and five measures; ``itemsets`` must hold all subsets of its sets.

    Rules by confidence are grown from small consequents, for itemsets of any size.
    """
    if metric not in ("support", "confidence", "lift", "conviction", "leverage"):
        raise ValueError(f"unknown metric '{metric}'")
    itemsets = durable(itemsets.select("items", "size", "support_count", "support"))
    ant = itemsets.select(
        F.col("items").alias("antecedent"), F.col("support_count").alias("_ac"), F.col("support").alias("_as")
    )
    con = itemsets.select(F.col("items").alias("consequent"), F.col("support").alias("_cs"))
    if metric == "confidence":
        scored = _confident_splits(itemsets, ant, min_threshold)
    else:
        scored = _splits(itemsets).join(ant, "antecedent").withColumn("confidence", F.col("support_count") / F.col("_ac"))
    certain = F.col("support_count") == F.col("_ac")
    rules = (
        scored.join(con, "consequent")
        .withColumn("lift", F.col("confidence") / F.col("_cs"))
        .withColumn(
            "conviction",
            F.when(certain, F.lit(float("inf"))).otherwise(F.try_divide(1 - F.col("_cs"), 1 - F.col("confidence"))),
        )
        .withColumn("leverage", F.col("support") - F.col("_as") * F.col("_cs"))
    )
    if metric != "confidence":
        rules = rules.where(F.col(metric) >= min_threshold)
    return rules.select(
        "antecedent", "consequent", "support_count", "support", "confidence", "lift", "conviction", "leverage"
    )


def sequential_rules(patterns: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Each pattern of two or more elements, split at every position."""
    n = F.col("n_elements")
    splits = patterns.where("n_elements >= 2").select(
        "elements", "n_elements", "support_count", "support", F.explode(F.sequence(F.lit(1), n - 1)).alias("_at")
    )
    sides = splits.select(
        F.slice("elements", F.lit(1), F.col("_at")).alias("antecedent"),
        F.slice("elements", F.col("_at") + 1, n - F.col("_at")).alias("consequent"),
        "support_count",
        "support",
    )
    ant = patterns.select(F.col("elements").alias("antecedent"), F.col("support_count").alias("_ac"))
    con = patterns.select(F.col("elements").alias("consequent"), F.col("support").alias("_cs"))
    return (
        sides.join(ant, "antecedent")
        .withColumn("confidence", F.col("support_count") / F.col("_ac"))
        .where(F.col("confidence") >= min_confidence)
        .join(con, "consequent", "left")
        .select(
            "antecedent",
            "consequent",
            "support_count",
            "support",
            "confidence",
            F.when(F.col("_cs") > 0, F.col("confidence") / F.col("_cs")).otherwise(F.lit(float("inf"))).alias("lift"),
        )
    )


def actionable(rules: DataFrame, min_lift: float = 2.0, min_confidence: float = 0.5) -> DataFrame:
    """Rules strictly above both bounds."""
    return rules.where((F.col("lift") > min_lift) & (F.col("confidence") > min_confidence))
