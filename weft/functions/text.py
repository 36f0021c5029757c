"""Text forms of itemsets, patterns and rules, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _escaped(item) -> Column:
    """The marks that keys are built with, and the escape itself, after a backslash."""
    return F.regexp_replace(item, r"([\\|>])", r"\\$1")


def itemset_key(items) -> Column:
    """``a|b|c``; different itemsets have different keys, whatever their items hold."""
    return F.array_join(F.transform(F.sort_array(_col(items)), lambda i: _escaped(i.cast("string"))), "|")


def pattern_key(elements) -> Column:
    """``a|b>c``"""
    return F.array_join(F.transform(_col(elements), itemset_key), ">")


def braces(items) -> Column:
    """``{a, b}``"""
    return F.concat(F.lit("{"), F.array_join(F.sort_array(_col(items)), ", "), F.lit("}"))


def pattern_text(elements) -> Column:
    """``<{a, b}, {c}>``"""
    return F.concat(F.lit("<"), F.array_join(F.transform(_col(elements), braces), ", "), F.lit(">"))


def rule_text(antecedent, consequent, side=braces) -> Column:
    """``{a} -> {b}``; pass ``side=pattern_text`` for sequential rules."""
    return F.concat(side(antecedent), F.lit(" -> "), side(consequent))


def truncate(text, length: int) -> Column:
    return F.substring(_col(text), 1, length)
