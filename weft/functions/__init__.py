from .support import min_count, mllib_support
from .text import braces, itemset_key, pattern_key, pattern_text, rule_text, truncate
from .containment import contains_pattern

__all__ = [
    "braces", "contains_pattern", "itemset_key", "min_count", "mllib_support",
    "pattern_key", "pattern_text", "rule_text", "truncate",
]
