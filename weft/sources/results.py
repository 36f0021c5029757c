"""Result sinks: one directory per table, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import itemset_key, pattern_key
from ..operators.evaluate import pattern_lengths, size_distribution
from ..plans.grid import GridResult
from ..plans.report import top_patterns, top_rules


def json_lines(df: DataFrame) -> DataFrame:
    """Rows as JSON text; numbers stay numbers, and an infinite lift or conviction is the string ``inf``."""
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"})
    return df.select(F.regexp_replace(line, '"(lift|conviction)":"Infinity"', '"$1":"inf"').alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    json_lines(df).write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Arrays as text: ``a|b`` for itemsets and ``a|b>c`` for patterns."""
    texts = {}
    for f in df.schema:
        if isinstance(f.dataType, ArrayType):
            nested = isinstance(f.dataType.elementType, ArrayType)
            texts[f.name] = pattern_key(f.name) if nested else itemset_key(f.name)
    df.withColumns(texts).write.option("header", True).csv(path)


def write_grid_json(result: GridResult, path: str, top: int = 20) -> None:
    """Summary, metrics and, per cell, the top rules (and patterns) and how many itemsets (patterns) have each size."""
    result.summary().write.json(f"{path}/summary")
    result.metrics().write.json(f"{path}/metrics")
    for i, cell in enumerate(result.cells.values()):
        tag = {"dataset": F.lit(cell.dataset), "algorithm": F.lit(cell.algorithm)}
        sizes = pattern_lengths(cell.found) if result.found == "patterns" else size_distribution(cell.found)
        write_json(sizes.withColumns(tag), f"{path}/size_distribution/cell={i}")
        write_json(top_rules(cell.rules, top).withColumns(tag), f"{path}/top_rules/cell={i}")
        if result.found == "patterns":
            write_json(top_patterns(cell.found, top).withColumns(tag), f"{path}/top_patterns/cell={i}")
