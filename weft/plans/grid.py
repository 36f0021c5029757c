"""Experiment grids, sweeps and comparisons.

Datasets are cached once per grid; every run is a set of Spark jobs and the
long result table has one row per metric.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import min_count
from ..operators import evaluate, rules as rule_ops
from ..runtime import cached, durable

Miner = Callable[[DataFrame], DataFrame]
# (found, rules, data) -> table with one row
Evaluator = Callable[[DataFrame, DataFrame, DataFrame], DataFrame]

RESULT_SCHEMA = "dataset string, algorithm string, evaluator string, metric string, value double"


@dataclass
class Cell:
    """One dataset mined by one algorithm."""

    dataset: str
    algorithm: str
    found: DataFrame
    rules: DataFrame
    n_rows: int
    n_found: int
    n_rules: int
    seconds: float
    metrics: DataFrame


@dataclass
class Grid:
    """Datasets x algorithms x evaluators, keyed by the caller's labels."""

    min_confidence: float = 0.5
    sequential: bool = False
    datasets: dict[str, DataFrame] = field(default_factory=dict)
    algorithms: dict[str, Miner] = field(default_factory=dict)
    evaluators: dict[str, Evaluator] = field(default_factory=dict)

    def _add(self, table: dict, label: str, value) -> Grid:
        if label in table:
            raise ValueError(f"label '{label}' is already used")
        table[label] = value
        return self

    def add_dataset(self, label: str, data: DataFrame) -> Grid:
        return self._add(self.datasets, label, data)

    def add_algorithm(self, label: str, miner: Miner) -> Grid:
        return self._add(self.algorithms, label, miner)

    def add_evaluator(self, label: str, evaluator: Evaluator) -> Grid:
        return self._add(self.evaluators, label, evaluator)

    def _rules(self, found: DataFrame) -> DataFrame:
        if self.sequential:
            return rule_ops.sequential_rules(found, self.min_confidence)
        return rule_ops.association_rules(found, "confidence", self.min_confidence)

    def run(self) -> GridResult:
        if not self.datasets:
            raise ValueError("no datasets added")
        if not self.algorithms:
            raise ValueError("no algorithms added")
        cells = {}
        for dataset, data in self.datasets.items():
            cells |= self._cells(dataset, data)
        return GridResult(cells, len(self.evaluators), "patterns" if self.sequential else "itemsets")

    def _cells(self, dataset: str, rows: DataFrame) -> dict[tuple[str, str], Cell]:
        cells = {}
        with cached(rows) as data:
            n_rows = data.select("sequence_id").distinct().count() if self.sequential else data.count()
            for algorithm, miner in self.algorithms.items():
                began = time.perf_counter()
                found = durable(miner(data))
                rules = durable(self._rules(found))
                n_found, n_rules = found.count(), rules.count()
                seconds = time.perf_counter() - began
                names = ("patterns", "sequences") if self.sequential else ("itemsets", "transactions")
                profile = evaluate.run_profile(seconds, n_rows, n_found, n_rules, *names)
                profile |= {f"n_{names[0]}": float(n_found), "n_rules": float(n_rules), f"n_{names[1]}": float(n_rows)}
                rows = [(dataset, algorithm, "run", m, v) for m, v in profile.items()]
                metrics = data.sparkSession.createDataFrame(rows, RESULT_SCHEMA)
                for name, evaluator in self.evaluators.items():
                    metrics = metrics.unionByName(_long(evaluator(found, rules, data), dataset, algorithm, name))
                cells[dataset, algorithm] = Cell(
                    dataset, algorithm, found, rules, n_rows, n_found, n_rules, seconds, durable(metrics)
                )
        return cells


def _long(row: DataFrame, dataset: str, algorithm: str, evaluator: str) -> DataFrame:
    """A one-row metric table to long form."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns]
    )
    return row.select(F.inline(pairs)).select(
        F.lit(dataset).alias("dataset"),
        F.lit(algorithm).alias("algorithm"),
        F.lit(evaluator).alias("evaluator"),
        "metric",
        "value",
    )


@dataclass
class GridResult:
    cells: dict[tuple[str, str], Cell]
    n_evaluators: int
    found: str

    def get(self, dataset: str, algorithm: str) -> Cell | None:
        return self.cells.get((dataset, algorithm))

    def metrics(self) -> DataFrame:
        """``(dataset, algorithm, evaluator, metric, value)`` over all cells."""
        out = None
        for cell in self.cells.values():
            out = cell.metrics if out is None else out.unionByName(cell.metrics)
        return out

    def summary(self) -> DataFrame:
        """Totals over the grid, in one row."""
        long = self.metrics().where("evaluator = 'run'")
        total = lambda m: F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("value"))), F.lit(0.0))
        return long.agg(
            F.countDistinct("dataset").alias("num_datasets"),
            F.countDistinct("algorithm").alias("num_algorithms"),
            F.lit(self.n_evaluators).alias("num_evaluators"),
            total(f"n_{self.found}").cast("bigint").alias(f"total_{self.found}_found"),
            total("n_rules").cast("bigint").alias("total_rules_generated"),
            total("execution_time").alias("total_execution_time"),
        )

    def comparison(self) -> DataFrame:
        """One row per dataset and algorithm: results, time, throughput."""
        long = self.metrics().where("evaluator = 'run'")
        value = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
        rows = "sequences" if self.found == "patterns" else "transactions"
        return long.groupBy("dataset", "algorithm").agg(
            value(f"n_{self.found}").cast("bigint").alias(f"n_{self.found}"),
            value("n_rules").cast("bigint").alias("n_rules"),
            value("execution_time").alias("seconds"),
            value(f"{rows}_per_second").alias("throughput"),
        )


def _per_threshold(df: DataFrame, name: str, values: list[float], keep: Callable[[float], Column], figures: dict) -> DataFrame:
    """One pass over ``df``; per threshold, each figure over the rows it keeps. Every threshold is listed."""
    aggregates = [
        F.struct(F.lit(float(v)).alias(name), *[figure(keep(v)).alias(f) for f, figure in figures.items()])
        for v in values
    ]
    return df.agg(F.array(*aggregates).alias("rows")).select(F.inline("rows"))


def _mean_of(column: str) -> Callable[[Column], Column]:
    return lambda kept: F.coalesce(F.avg(F.when(kept, F.col(column))), F.lit(0.0))


def support_sweep(found: DataFrame, n: int, supports: list[float]) -> DataFrame:
    """Number of itemsets (or patterns) per minimum support, from one mining run at the lowest.

    Exact by downward closure.
    """
    keep = lambda s: F.col("support_count") >= min_count(s, n)
    return _per_threshold(found, "min_support", supports, keep, {"n_found": F.count_if})


_RULE_FIGURES = {"n_rules": F.count_if, "avg_lift": _mean_of("lift"), "avg_support": _mean_of("support")}


def confidence_sweep(rules: DataFrame, confidences: list[float]) -> DataFrame:
    """Rules, average lift and support per minimum confidence, from the rules of the lowest."""
    return _per_threshold(rules, "min_confidence", confidences, lambda c: F.col("confidence") >= c, _RULE_FIGURES)


def rule_support_sweep(rules: DataFrame, n: int, supports: list[float]) -> DataFrame:
    """Rules, average lift and support per minimum support, from the rules of the lowest."""
    keep = lambda s: F.col("support_count") >= min_count(s, n)
    return _per_threshold(rules, "min_support", supports, keep, _RULE_FIGURES)


def timed_sweep(spark: SparkSession, algorithms: dict[str, Callable[[float], DataFrame]], supports: list[float]) -> DataFrame:
    """Wall time per algorithm and threshold; each run is mined in full, which is what the figure is about."""
    rows = []
    for name, mine in algorithms.items():
        for s in supports:
            began = time.perf_counter()
            n = mine(s).count()
            rows.append((name, float(s), n, time.perf_counter() - began))
    return spark.createDataFrame(rows, "algorithm string, min_support double, n_found bigint, seconds double")


def fastest(timings: DataFrame) -> DataFrame:
    """Fastest algorithm per threshold, its rate, and the total time spent there."""
    return timings.groupBy("min_support").agg(
        F.min_by("algorithm", "seconds").alias("fastest"),
        F.min("seconds").alias("seconds"),
        F.coalesce(F.try_divide(F.min_by("n_found", "seconds"), F.min("seconds")), F.lit(0.0)).alias("found_per_second"),
        F.sum("seconds").alias("total_seconds"),
    )


def time_ratio(comparison: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """Time on one dataset over time on another, per algorithm."""
    seconds = lambda d: F.max(F.when(F.col("dataset") == d, F.col("seconds")))
    return comparison.groupBy("algorithm").agg(
        F.try_divide(seconds(numerator), seconds(denominator)).alias("time_ratio")
    )


def dataset_profile(baskets: DataFrame, itemsets: DataFrame, rules: DataFrame, label: str) -> DataFrame:
    """Vocabulary, baskets, itemsets, rules and rule averages of one dataset, in one row."""
    parts = [
        baskets.agg(F.count(F.lit(1)).alias("n_baskets")),
        baskets.select(F.explode("items").alias("item")).agg(F.countDistinct("item").alias("n_items")),
        itemsets.agg(F.count(F.lit(1)).alias("n_itemsets")),
        rules.agg(
            F.count(F.lit(1)).alias("n_rules"),
            F.avg("confidence").alias("avg_confidence"),
            F.avg("lift").alias("avg_lift"),
            F.max("lift").alias("max_lift"),
        ),
    ]
    return evaluate._one_row(*parts).select(F.lit(label).alias("dataset"), "*")


def dataset_comparison(*profiles: DataFrame) -> DataFrame:
    out = profiles[0]
    for profile in profiles[1:]:
        out = out.unionByName(profile)
    return out
