"""Itemset, pattern and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import pattern_text, rule_text, truncate
from weft.operators import baskets, itemsets, patterns, rules, sequences
from weft.plans import report
from weft.runtime import cached

from . import data, sql
from .registry import query

# -- itemsets -------------------------------------------------------------------------------------

BRAND, TYPE = 0.005, 0.01
_BRAND_SETS = f"WITH {sql.itemsets('brand', BRAND, 4)} SELECT {sql.ITEMSET_COLUMNS} FROM itemsets"
_TYPE_SETS = f"WITH {sql.itemsets('type', TYPE, 6)} SELECT {sql.ITEMSET_COLUMNS} FROM itemsets"


@query("apriori_itemsets", _BRAND_SETS)
def apriori_itemsets(spark, sf):
    return itemsets.apriori(data.brand_baskets(spark, sf), BRAND)


@query("fpgrowth_itemsets", _BRAND_SETS)
def fpgrowth_itemsets(spark, sf):
    return itemsets.fpgrowth(data.brand_baskets(spark, sf), BRAND)


@query("eclat_itemsets", _BRAND_SETS)
def eclat_itemsets(spark, sf):
    return itemsets.eclat(data.brand_baskets(spark, sf), BRAND)


@query("apriori_itemsets_dense", _TYPE_SETS)
def apriori_itemsets_dense(spark, sf):
    return itemsets.apriori(data.type_baskets(spark, sf), TYPE)


@query("eclat_itemsets_dense", _TYPE_SETS)
def eclat_itemsets_dense(spark, sf):
    return itemsets.eclat(data.type_baskets(spark, sf), TYPE)


@query("fpgrowth_itemsets_dense", _TYPE_SETS)
def fpgrowth_itemsets_dense(spark, sf):
    return itemsets.fpgrowth(data.type_baskets(spark, sf), TYPE)


# Nearly every pair of part and return flag is an item: many more items than a basket holds.
_WIDE_ITEM = "CAST(l_partkey AS VARCHAR) || l_returnflag"
WIDE = 0.00035
_WIDE_SETS = f"""WITH {sql.itemsets('', WIDE, 2, query=f"SELECT DISTINCT l_orderkey AS tid, {_WIDE_ITEM} AS item FROM lineitem")}
SELECT {sql.ITEMSET_COLUMNS} FROM itemsets"""


def _wide(spark, sf):
    lines = data.table(spark, sf, "lineitem")
    return baskets.grouped(lines.withColumn("item", F.concat(F.col("l_partkey").cast("string"), "l_returnflag")), "l_orderkey", "item")


@query("apriori_itemsets_wide", _WIDE_SETS)
def apriori_itemsets_wide(spark, sf):
    return itemsets.apriori(_wide(spark, sf), WIDE, max_len=2)


@query("eclat_itemsets_wide", _WIDE_SETS)
def eclat_itemsets_wide(spark, sf):
    return itemsets.eclat(_wide(spark, sf), WIDE, max_len=2)


@query("itemsets_maxlen", _TYPE_SETS + " WHERE size <= 2")
def itemsets_maxlen(spark, sf):
    return itemsets.apriori(data.type_baskets(spark, sf), TYPE, max_len=2)


@query("itemsets_maxlen_fpgrowth", _TYPE_SETS + " WHERE size <= 3")
def itemsets_maxlen_fpgrowth(spark, sf):
    return itemsets.fpgrowth(data.type_baskets(spark, sf), TYPE, max_len=3)


@query("itemsets_by_id", _BRAND_SETS)
def itemsets_by_id(spark, sf):
    """Mined on ids, named afterwards."""
    named = data.brand_baskets(spark, sf)
    dictionary = sequences.item_dictionary(baskets.explode_items(named))
    return baskets.decode(itemsets.fpgrowth(baskets.encode(named, dictionary), BRAND), dictionary)


@query("long_itemsets", _TYPE_SETS + " WHERE size >= 3")
def long_itemsets(spark, sf):
    return report.at_least(itemsets.fpgrowth(data.type_baskets(spark, sf), TYPE), 3)


@query("top_itemsets", _BRAND_SETS + f" ORDER BY support_count DESC, {sql.text('items')} LIMIT 5")
def top_itemsets(spark, sf):
    return report.top_itemsets(itemsets.fpgrowth(data.brand_baskets(spark, sf), BRAND), 5)


@query(
    "algorithms_agree",
    f"WITH {sql.itemsets('brand', 0.01, 3)} SELECT {sql.text('items')} AS found, support_count, '' AS algorithms FROM itemsets WHERE false",
)
def algorithms_agree(spark, sf):
    with cached(data.brand_baskets(spark, sf)) as b:
        return itemsets.disagreements({name: mine(b, 0.01) for name, mine in itemsets.ALGORITHMS.items()})


# -- association rules ----------------------------------------------------------------------------

_TYPE_CTES = f"WITH {sql.itemsets('type', TYPE, 6)}, "
_BRAND_CTES = f"WITH {sql.itemsets('brand', BRAND, 4)}, "


def type_rules(spark, sf, metric="confidence", bound=0.4):
    return rules.association_rules(itemsets.fpgrowth(data.type_baskets(spark, sf), TYPE), metric, bound)


def brand_rules(spark, sf, bound=0.15):
    return rules.association_rules(itemsets.fpgrowth(data.brand_baskets(spark, sf), BRAND), "confidence", bound)


_BASIC = ("antecedent", "consequent", "support_count", "support", "confidence", "lift")


@query("association_rules", f"{_TYPE_CTES}{sql.rules('confidence >= 0.4')} SELECT {sql.RULE_COLUMNS} FROM rules")
def association_rules(spark, sf):
    return type_rules(spark, sf).select(*_BASIC)


@query("association_rules_sparse", f"{_BRAND_CTES}{sql.rules('confidence >= 0.15')} SELECT {sql.RULE_COLUMNS} FROM rules")
def association_rules_sparse(spark, sf):
    return brand_rules(spark, sf).select(*_BASIC)


@query("rules_by_lift", f"{_TYPE_CTES}{sql.rules('lift >= 1.0')} SELECT {sql.RULE_COLUMNS} FROM rules")
def rules_by_lift(spark, sf):
    return report.rules_by_lift(type_rules(spark, sf, "lift", 1.0)).select(*_BASIC)


@query(
    "rule_metrics",
    f"""{_TYPE_CTES}{sql.rules('confidence >= 0.3')} SELECT {sql.RULE_COLUMNS}, round(conviction, 6) AS conviction,
    certain, round(leverage, 6) AS leverage FROM rules""",
)
def rule_metrics(spark, sf):
    certain = F.col("conviction") == float("inf")
    return type_rules(spark, sf, bound=0.3).select(
        *_BASIC, F.when(~certain, F.col("conviction")).alias("conviction"), certain.alias("certain"), "leverage"
    )


@query(
    "actionable_rules",
    f"""{_BRAND_CTES}{sql.rules('lift > 1.05 AND confidence > 0.15')} SELECT {sql.RULE_COLUMNS} FROM rules
    ORDER BY rules.lift DESC, {sql.text('rules.antecedent')}, {sql.text('rules.consequent')} LIMIT 5""",
)
def actionable_rules(spark, sf):
    found = rules.actionable(brand_rules(spark, sf), min_lift=1.05, min_confidence=0.15)
    return report.top_rules(found, 5, by="lift").select(*_BASIC)


def _braced(column: str) -> str:
    return f"'{{' || array_to_string({column}, ', ') || '}}'"


@query(
    "format_rules",
    f"""{_TYPE_CTES}{sql.rules('confidence >= 0.4')}, t AS (
    SELECT {_braced('antecedent')} || ' -> ' || {_braced('consequent')} AS rule, support_count FROM rules)
    SELECT rule, substring(rule, 1, 20) AS short_rule, support_count FROM t""",
)
def format_rules(spark, sf):
    text = rule_text("antecedent", "consequent")
    return type_rules(spark, sf).select(text.alias("rule"), truncate(text, 20).alias("short_rule"), "support_count")


def _ordered(by: str, n: int) -> str:
    return f" ORDER BY rules.{by} DESC, {sql.text('rules.antecedent')}, {sql.text('rules.consequent')} LIMIT {n}"


@query(
    "top_rules_confidence",
    f"{_TYPE_CTES}{sql.rules('confidence >= 0.4')} SELECT {sql.RULE_COLUMNS} FROM rules{_ordered('confidence', 20)}",
)
def top_rules_confidence(spark, sf):
    return report.top_rules(type_rules(spark, sf), 20).select(*_BASIC)


@query(
    "top_rules_lift",
    f"{_BRAND_CTES}{sql.rules('confidence >= 0.15')} SELECT {sql.RULE_COLUMNS} FROM rules{_ordered('lift', 10)}",
)
def top_rules_lift(spark, sf):
    return report.top_rules(brand_rules(spark, sf), 10, by="lift").select(*_BASIC)


# -- sequential patterns --------------------------------------------------------------------------

PRIORITY, EVENT, SESSION, PURCHASE = 0.3, 0.9, 0.1, 0.5


def _patterns(source: str, support: float) -> str:
    return f"WITH {sql.patterns(source, support)} SELECT {sql.PATTERN_COLUMNS} FROM patterns"


@query("seq_frequent_items", f"WITH {sql.patterns('priority', PRIORITY)} SELECT key AS item, support_count, "
       "round(support, 6) AS support FROM patterns WHERE n_items = 1")
def seq_frequent_items(spark, sf):
    return patterns.frequent_items(data.priority_sequences(spark, sf), PRIORITY)


@query("prefixspan_patterns", _patterns("priority", PRIORITY))
def prefixspan_patterns(spark, sf):
    return patterns.prefixspan(data.priority_sequences(spark, sf), PRIORITY, max_items=3)


@query("gsp_patterns", _patterns("priority", PRIORITY))
def gsp_patterns(spark, sf):
    return patterns.gsp(data.priority_sequences(spark, sf), PRIORITY, max_items=3)


@query("spade_patterns", _patterns("priority", PRIORITY))
def spade_patterns(spark, sf):
    return patterns.spade(data.priority_sequences(spark, sf), PRIORITY, max_items=3)


@query("cm_spade_patterns", _patterns("priority", PRIORITY))
def cm_spade_patterns(spark, sf):
    return patterns.cm_spade(data.priority_sequences(spark, sf), PRIORITY, max_items=3)


@query("prefixspan_events", _patterns("event", EVENT))
def prefixspan_events(spark, sf):
    return patterns.prefixspan(data.event_sequences(spark, sf), EVENT, max_items=3)


@query("spade_events", _patterns("event", EVENT))
def spade_events(spark, sf):
    return patterns.spade(data.event_sequences(spark, sf), EVENT, max_items=3)


@query("gsp_sessions", _patterns("session720", SESSION))
def gsp_sessions(spark, sf):
    return patterns.gsp(data.event_sessions(spark, sf, 720), SESSION, max_items=3)


@query("spade_purchases", _patterns("purchase", PURCHASE))
def spade_purchases(spark, sf):
    return patterns.spade(data.purchase_sequences(spark, sf), PURCHASE, max_items=3)


@query("cm_spade_purchases", _patterns("purchase", PURCHASE))
def cm_spade_purchases(spark, sf):
    return patterns.cm_spade(data.purchase_sequences(spark, sf), PURCHASE, max_items=3)


@query("gsp_purchases", _patterns("purchase", PURCHASE))
def gsp_purchases(spark, sf):
    return patterns.gsp(data.purchase_sequences(spark, sf), PURCHASE, max_items=3)


def _four(source: str, support: float) -> str:
    return f"WITH {sql.patterns(source, support, 4)} SELECT {sql.PATTERN_COLUMNS} FROM patterns"


@query("prefixspan_four_items", _four("priority", 0.4))
def prefixspan_four_items(spark, sf):
    return patterns.prefixspan(data.priority_sequences(spark, sf), 0.4, max_items=4)


@query("gsp_four_items", _four("priority", 0.4))
def gsp_four_items(spark, sf):
    return patterns.gsp(data.priority_sequences(spark, sf), 0.4, max_items=4)


@query("spade_four_items", _four("purchase", 0.8))
def spade_four_items(spark, sf):
    return patterns.spade(data.purchase_sequences(spark, sf), 0.8, max_items=4)


@query("cm_spade_four_items", _four("event", 0.97))
def cm_spade_four_items(spark, sf):
    return patterns.cm_spade(data.event_sequences(spark, sf), 0.97, max_items=4)


@query("patterns_maxlen", _patterns("purchase", PURCHASE) + " WHERE n_elements <= 2")
def patterns_maxlen(spark, sf):
    return patterns.spade(data.purchase_sequences(spark, sf), PURCHASE, max_items=3, max_elements=2)


@query("patterns_agree", f"WITH {sql.patterns('session720', SESSION)} SELECT key AS found, support_count, '' AS algorithms FROM patterns WHERE false")
def patterns_agree(spark, sf):
    elements = data.event_sessions(spark, sf, 720)
    return itemsets.disagreements({n: mine(elements, SESSION, max_items=3) for n, mine in patterns.ALGORITHMS.items()})


@query(
    "cooccurrence_map",
    f"""WITH {sql.patterns('purchase', PURCHASE)} SELECT CASE WHEN n_elements = 2 THEN 's' ELSE 'i' END AS kind,
    regexp_split_to_array(key, '[>|]')[1] AS first_item, regexp_split_to_array(key, '[>|]')[2] AS second_item, support_count
    FROM patterns WHERE n_items = 2""",
)
def cooccurrence_map(spark, sf):
    return patterns.cooccurrence(data.purchase_sequences(spark, sf), PURCHASE)


@query("multi_event_patterns", _patterns("purchase", PURCHASE) + " WHERE n_elements > 1")
def multi_event_patterns(spark, sf):
    return report.multi_event(patterns.prefixspan(data.purchase_sequences(spark, sf), PURCHASE, max_items=3))


@query("two_event_patterns", _patterns("purchase", PURCHASE) + " WHERE n_elements = 2")
def two_event_patterns(spark, sf):
    return report.multi_event(patterns.prefixspan(data.purchase_sequences(spark, sf), PURCHASE, max_items=3), exactly=2)


@query(
    "top_patterns",
    f"WITH {sql.patterns('priority', PRIORITY)} SELECT {sql.PATTERN_COLUMNS}, round(100.0 * support, 6) AS support_percent "
    "FROM patterns ORDER BY support_count DESC, key LIMIT 20",
)
def top_patterns(spark, sf):
    return report.top_patterns(patterns.prefixspan(data.priority_sequences(spark, sf), PRIORITY, max_items=3), 20)


_SRULES = f"WITH {sql.patterns('purchase', PURCHASE)}, {sql.sequence_rules(0.8)} "
SRULE_COLUMNS = (
    "antecedent, consequent, support_count, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift"
)


def purchase_rules(spark, sf, bound=0.8, elements=None):
    given = data.purchase_sequences(spark, sf) if elements is None else elements
    found = patterns.prefixspan(given, PURCHASE, max_items=3)
    return found, rules.sequential_rules(found, bound)


@query("sequential_rules", f"{_SRULES} SELECT {SRULE_COLUMNS} FROM srules")
def sequential_rules(spark, sf):
    return purchase_rules(spark, sf)[1]


@query(
    "sp_top_rules",
    f"{_SRULES} SELECT {SRULE_COLUMNS} FROM srules ORDER BY srules.confidence DESC, antecedent, consequent LIMIT 20",
)
def sp_top_rules(spark, sf):
    return report.top_rules(purchase_rules(spark, sf)[1], 20)


@query(
    "format_sequential_rules",
    f"""{_SRULES}, t AS (SELECT '<{{' || replace(replace(antecedent, '|', ', '), '>', '}}, {{') || '}}> -> <{{'
      || replace(replace(consequent, '|', ', '), '>', '}}, {{') || '}}>' AS rule, support_count FROM srules)
    SELECT rule, support_count FROM t""",
)
def format_sequential_rules(spark, sf):
    text = rule_text("antecedent", "consequent", side=pattern_text)
    return purchase_rules(spark, sf)[1].select(text.alias("rule"), "support_count")
