"""Registered queries over the driver's tables, each with its DuckDB counterpart where SQL can say it."""

from . import baskets, evaluation, mining, sequences, sources, sweeps  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
