"""Basket builders: rows to ``(tid, items)`` with sorted, distinct, non-empty items."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import require_columns
from .clean import clean_rows, item_text


def grouped_pairs(df: DataFrame, group: str, item: str, null_items: str = "drop") -> DataFrame:
    """Distinct ``(tid, item)`` pairs.

    Duplicates collapse map-side and the shuffle is on the pair, so a key that
    owns a large share of the rows is spread over all partitions.
    """
    require_columns(df, group, item)
    pairs = df.select(F.col(group).alias("tid"), item_text(item, null_items).alias("item"))
    return pairs.where("tid IS NOT NULL AND item IS NOT NULL").distinct()


def collect_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct pairs to one row per basket; a basket is at most one row per distinct item."""
    return pairs.groupBy("tid").agg(F.sort_array(F.collect_list("item")).alias("items"))


def grouped(df: DataFrame, group: str, item: str, null_items: str = "drop") -> DataFrame:
    """One basket per group key."""
    return collect_pairs(grouped_pairs(df, group, item, null_items))


def grouped_clean(df: DataFrame, group: str, item: str) -> DataFrame:
    """``grouped`` after dropping null keys and items and trimming item text."""
    return grouped(clean_rows(df, group, item), group, item)


def _trimmed(values: Column) -> Column:
    trimmed = F.transform(values, lambda v: F.trim(v.cast("string")))
    return F.sort_array(F.array_distinct(F.filter(trimmed, lambda v: v != "")))


def _ready_made(df: DataFrame, tid: str, items: Column) -> DataFrame:
    require_columns(df, tid)
    return df.select(F.col(tid).alias("tid"), items.alias("items")).where(F.size("items") > 0)


def delimited(df: DataFrame, tid: str, column: str, delimiter: str = ",") -> DataFrame:
    """Each row holds a basket as delimited text."""
    require_columns(df, column)
    return _ready_made(df, tid, _trimmed(F.split(F.col(column), re.escape(delimiter))))


def wide(df: DataFrame, tid: str, columns: list[str]) -> DataFrame:
    """Each row holds a basket across several columns; absent columns are skipped."""
    present = [F.col(c).cast("string") for c in columns if c in df.columns]
    if not present:
        return _ready_made(df, tid, F.array().cast("array<string>"))
    return _ready_made(df, tid, _trimmed(F.array(*present)))


def from_rows(
    df: DataFrame,
    tid: str,
    item_columns: list[str] | None = None,
    item_string_col: str | None = None,
    delimiter: str = ",",
) -> DataFrame:
    """Row-per-basket input, either delimited or wide."""
    if item_string_col:
        return delimited(df, tid, item_string_col, delimiter)
    if item_columns is None:
        raise ValueError("either item_columns or item_string_col must be given")
    return wide(df, tid, item_columns)


def custom(df: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A caller's own builder; it must return ``tid`` and ``items``. Null items are dropped."""
    out = df.transform(build)
    require_columns(out, "tid", "items")
    items = F.filter("items", lambda i: i.isNotNull())
    return out.select("tid", F.sort_array(F.array_distinct(items)).alias("items")).where(F.size("items") > 0)


def explode_items(baskets: DataFrame) -> DataFrame:
    return baskets.select("tid", F.explode("items").alias("item"))


def one_hot(baskets: DataFrame, vocabulary: list[str]) -> DataFrame:
    """One boolean column per item of a closed vocabulary; no shuffle."""
    return baskets.select(
        "tid", *[F.array_contains("items", F.lit(v)).alias(v) for v in vocabulary]
    )


def encode(baskets: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``items`` as sorted ids of a dictionary (item, item_id), see ``sequences.item_dictionary``; items it lacks are left out."""
    coded = explode_items(baskets).join(dictionary.select("item", "item_id"), "item", "left")
    return coded.groupBy("tid").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def decode(itemsets: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Itemsets of ids with the sorted names of the dictionary (item, item_id) in their place; other columns stay."""
    named = itemsets.select(F.col("items").alias("_ids"), F.explode("items").alias("item_id")).join(dictionary.select("item", "item_id"), "item_id")
    names = named.groupBy("_ids").agg(F.sort_array(F.collect_list("item")).alias("_names"))
    back = itemsets.join(names, F.col("items") == F.col("_ids"))
    return back.select(*[F.col("_names").alias("items") if c == "items" else F.col(f"`{c}`") for c in itemsets.columns])


def one_hot_sparse(baskets: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One-hot rows over an open vocabulary: ``(tid, indices)``, the 0-based places of a basket's items in the dictionary.

    The vocabulary is a table (item, item_id from 1), so it may have any number of items.
    """
    return encode(baskets, dictionary).select("tid", F.transform("items", lambda i: i - 1).alias("indices"))


def vertical(baskets: DataFrame, chunk: Column | None = None, longest: int = 4096) -> DataFrame:
    """TID lists per item, split in chunks so that a popular item never becomes one huge row.

    ``chunk`` defaults to a hash of the tid in so many parts that a list holds about ``longest`` tids at most, however
    many baskets there are; pass a column of ``tid`` for range chunks.
    """
    if chunk is None:
        parts = max(1, -(-baskets.count() // longest))
    part = F.pmod(F.xxhash64("tid"), F.lit(parts)) if chunk is None else chunk
    return (
        explode_items(baskets)
        .groupBy("item", part.alias("chunk"))
        .agg(F.sort_array(F.collect_list("tid")).alias("tids"))
    )


def basket_stats(baskets: DataFrame) -> DataFrame:
    """Basket count, length figures, vocabulary size and the single-item warning, in one row."""
    lengths = baskets.agg(
        F.count(F.lit(1)).alias("n_baskets"),
        F.coalesce(F.avg(F.size("items")), F.lit(0.0)).alias("avg_items"),
        F.coalesce(F.max(F.size("items")), F.lit(0)).alias("max_items"),
        F.coalesce(F.min(F.size("items")), F.lit(0)).alias("min_items"),
    )
    vocabulary = explode_items(baskets).agg(F.countDistinct("item").alias("n_items"))
    both = lengths.unionByName(vocabulary, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
        "single_item_only", F.col("max_items") == 1
    )


def count_items(baskets: DataFrame, weight: str | None = None) -> DataFrame:
    """``(whole, item, support_count)``: baskets per item, and one row ``whole`` with the number of baskets.

    ``weight`` is a column that says how many baskets a row stands for.
    """
    flagged = F.transform("items", lambda i: F.struct(F.lit(False).alias("whole"), i.cast("string").alias("item")))
    basket = F.array(F.struct(F.lit(True).alias("whole"), F.lit(None).cast("string").alias("item")))
    rows = baskets.select(*([weight] if weight else []), F.inline(F.concat(flagged, basket)))
    return rows.groupBy("whole", "item").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("support_count"))


def item_support(baskets: DataFrame) -> DataFrame:
    """Support count and share per item.

    The basket count travels through the same shuffle, so one pass over the baskets is enough.
    """
    counted = count_items(baskets)
    total = counted.where("whole").select("support_count")
    return counted.where("NOT whole AND item IS NOT NULL").select(
        "item", "support_count", (F.col("support_count") / total.scalar()).alias("support")
    )
