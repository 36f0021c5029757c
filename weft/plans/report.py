"""Top-k tables and filters over mined results. Every limit has a unique last sort key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import itemset_key, pattern_key


def _top(df: DataFrame, by: list[str], ties: list, n: int) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in by], *ties).limit(n)


def _rule_ties(rules: DataFrame) -> list:
    nested = rules.schema["antecedent"].dataType.elementType.typeName() == "array"
    key = pattern_key if nested else itemset_key
    return [key("antecedent"), key("consequent")]


def top_rules(rules: DataFrame, n: int, by: str = "confidence") -> DataFrame:
    return _top(rules, [by], _rule_ties(rules), n)


def rules_by_lift(rules: DataFrame) -> DataFrame:
    """All rules by lift, then confidence."""
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), *_rule_ties(rules))


def top_patterns(patterns: DataFrame, n: int) -> DataFrame:
    """Most frequent patterns with their support in percent."""
    ranked = _top(patterns, ["support_count"], [pattern_key("elements")], n)
    return ranked.withColumn("support_percent", 100.0 * F.col("support"))


def top_itemsets(itemsets: DataFrame, n: int) -> DataFrame:
    return _top(itemsets, ["support_count"], [itemset_key("items")], n)


def top_items(item_support: DataFrame, n: int) -> DataFrame:
    return _top(item_support, ["support_count"], [F.col("item")], n)


def at_least(itemsets: DataFrame, k: int) -> DataFrame:
    """Itemsets of k or more items."""
    return itemsets.where(F.size("items") >= k)


def multi_event(patterns: DataFrame, exactly: int | None = None) -> DataFrame:
    """Patterns of more than one element, or of exactly so many."""
    return patterns.where(F.col("n_elements") > 1 if exactly is None else F.col("n_elements") == exactly)
