"""Query registration and the shared output form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from weft.functions import itemset_key, pattern_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Arrays as text, whole numbers as bigint, doubles to six places."""
    columns = []
    for f in df.schema:
        kind = f.dataType
        if isinstance(kind, ArrayType):
            text = pattern_key(f.name) if isinstance(kind.elementType, ArrayType) else itemset_key(f.name)
            columns.append(text.alias(f.name))
        elif kind.typeName() in ("integer", "short", "byte"):
            columns.append(F.col(f.name).cast("bigint").alias(f.name))
        elif kind.typeName() == "double":
            columns.append(F.round(f.name, 6).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; without ``sql`` the result is checked by rows only."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
