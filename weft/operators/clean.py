"""Row cleaning ahead of basket and sequence building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import require_columns


def item_text(column: str, null_items: str = "drop") -> Column:
    """Item as string; ``null_items='literal'`` turns a null into the item ``nan``."""
    text = F.col(column).cast("string")
    if null_items == "literal":
        return F.coalesce(text, F.lit("nan"))
    if null_items != "drop":
        raise ValueError("null_items must be 'drop' or 'literal'")
    return text


def clean_rows(
    df: DataFrame, key: str, item: str, time: str | None = None, integer_key: bool = False
) -> DataFrame:
    """Drop rows with a null key, item or time; trim items as strings; optionally cast the key to long."""
    needed = [key, item] + ([time] if time else [])
    require_columns(df, *needed)
    out = df.dropna(subset=needed).withColumn(item, F.trim(F.col(item).cast("string")))
    if integer_key:
        out = out.withColumn(key, F.expr(f"try_cast(`{key}` AS BIGINT)"))
    return out


def parse_dates(df: DataFrame, columns: list[str], fmt: str | None = None) -> DataFrame:
    """Text columns to timestamps; a value that does not fit the format becomes null."""
    require_columns(df, *columns)
    pattern = None if fmt is None else F.lit(fmt)
    return df.withColumns({c: F.try_to_timestamp(F.col(c), pattern) for c in columns})


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count and share per column, in one pass."""
    require_columns(df, *columns)
    total = F.count(F.lit(1))
    stats = df.agg(
        total.alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_null")) for i, c in enumerate(columns)]
    )
    return stats.select("n_rows", F.inline(rows)).select(
        "column_name",
        "n_rows",
        "n_null",
        F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).otherwise(0.0).alias("null_share"),
    )
