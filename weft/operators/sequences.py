"""Sequence builders.

A sequence is kept as one row per element, ``(sequence_id, position, items)``,
so that no operator has to hold a whole sequence in a task.
:func:`assemble` gives the nested one-row-per-sequence form where it is wanted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable, require_columns, small_side
from .clean import clean_rows, item_text

# A key with more rows than this is ordered in slices of rows instead of in one task.
HOT_ROWS = 4_000_000


def _time_us(df: DataFrame, time: str) -> Column:
    """Microseconds of a date or timestamp; a zone-less timestamp counts on its own clock."""
    kind, t = df.schema[time].dataType.simpleString(), F.col(time)
    if kind == "timestamp":
        return F.unix_micros(t)
    days = F.unix_date(F.to_date(t)) * F.lit(86_400_000_000)
    if kind == "date":
        return days
    if kind != "timestamp_ntz":
        raise TypeError(f"'{time}' is {kind}; parse it to a date or timestamp first")
    clock = (F.hour(t) * 3600 + F.minute(t) * 60).cast("bigint") * 1_000_000
    return days + clock + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def _in_order(time: str, ties: list[str]) -> list[Column]:
    return [F.asc_nulls_last(time), *[F.asc_nulls_last(t) for t in ties]]


def _sliced(
    df: DataFrame, keys: list[str], time: str, ties: list[str], hot_rows: int, sizing: DataFrame | None = None
) -> tuple[DataFrame, bool]:
    """Add ``_slice``: 0 for ordinary keys, an increasing slice of the rows for keys with very many.

    Sizes come from one map-side-combined pass over ``sizing`` (cheaper rows
    with the same keys, at least as many). The table of hot keys has at most
    (rows / hot_rows) rows. Their rows are laid out by ranges of (key, time,
    ties), so slices have about equal numbers of rows, also where all times
    are equal or null.
    """
    rows = df if sizing is None else sizing
    named = [f"_k{i}" for i in range(len(keys))]
    sizes = rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named)]).agg(F.count(F.lit(1)).alias("_n"))
    hot = durable(sizes.where(F.col("_n") > hot_rows))
    figures = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows")).first()
    if figures["keys"] == 0:
        return df.withColumn("_slice", F.lit(0).cast("bigint")), False
    same = [F.col(k) == F.col(n) for k, n in zip(keys, named)]
    side = small_side(hot.select(*named), figures["keys"])
    parts = -(-2 * figures["rows"] // hot_rows)
    laid_out = durable(df.join(side, same, "left_semi").repartitionByRange(parts, *keys, *_in_order(time, ties)))
    others = df.join(side, same, "left_anti").withColumn("_slice", F.lit(0).cast("bigint"))
    return others.unionByName(laid_out.withColumn("_slice", (F.spark_partition_id() + 1).cast("bigint"))), True


def _with_shift(df: DataFrame, shift: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Add the per-slice ``_before`` to ``column``. Only hot keys have slices to shift."""
    right = shift.select(
        *[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_os"), "_before"
    ).where("_before > 0")
    same = [F.col(k) == F.col(f"_o{i}") for i, k in enumerate(keys)] + [F.col("_slice") == F.col("_os")]
    return (
        df.join(right, same, "left")
        .withColumn(column, F.col(column) + F.coalesce("_before", F.lit(0)))
        .drop("_os", "_before", *[f"_o{i}" for i in range(len(keys))])
    )


def number_rows(
    df: DataFrame,
    keys: list[str],
    time: str,
    ties: list[str],
    hot_rows: int = HOT_ROWS,
    sizing: DataFrame | None = None,
    any_hot: bool = True,
) -> DataFrame:
    """Add the 1-based ``position`` of each row within its key by time, nulls last.

    Rows of a hot key are numbered slice by slice and shifted by the sizes of
    the earlier slices. ``any_hot=False`` says that the caller has already
    ruled hot keys out.
    """
    cut = df.withColumn("_slice", F.lit(0).cast("bigint"))
    if any_hot:
        cut, any_hot = _sliced(df, keys, time, ties, hot_rows, sizing)
    order = _in_order(time, ties)
    number = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    ranked = cut.withColumn("position", number.cast("bigint"))
    if any_hot:
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        sizes = cut.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size")).where("_slice IS NOT NULL")
        shift = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        ranked = _with_shift(ranked, shift, keys, "position")
    return ranked.drop("_slice")


def number_sessions(
    df: DataFrame, keys: list[str], time: str, ties: list[str], gap_minutes: float, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, bool]:
    """Add the 0-based ``session`` number per key; a session starts when the gap is strictly longer.

    Also says whether any key was hot.
    """
    cut, any_hot = _sliced(df, keys, time, ties, hot_rows)
    order = _in_order(time, ties)
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    gap = round(gap_minutes * 60_000_000)
    now = _time_us(df, time)
    starts = F.coalesce(now - F.lag(now).over(within) > gap, F.lit(False)).cast("bigint")
    marked = cut.withColumn("_start", starts)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn("session", F.sum("_start").over(running))
    if any_hot:
        # a slice also opens a session when the gap to the last event before it is long enough
        per_slice = marked.groupBy(*keys, "_slice").agg(
            F.sum("_start").alias("_starts"), F.min(now).alias("_first"), F.max(now).alias("_last")
        )
        slices = Window.partitionBy(*keys).orderBy("_slice")
        edge = F.coalesce(F.col("_first") - F.lag("_last").over(slices) > gap, F.lit(False)).cast("bigint")
        with_edge = per_slice.withColumn("_edge", edge).withColumn("_total", F.col("_starts") + F.col("_edge"))
        earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_total").over(earlier), F.lit(0)) + F.col("_edge")
        numbered = _with_shift(numbered, with_edge.withColumn("_before", before), keys, "session")
    return numbered.drop("_slice", "_start"), any_hot


def temporal(
    df: DataFrame, key: str, item: str, time: str, null_items: str = "drop", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Items that share a timestamp form one element; elements follow in time order."""
    require_columns(df, key, item, time)
    rows = df.select(
        F.col(key).alias("sequence_id"), F.col(time).alias("_t"), item_text(item, null_items).alias("_item")
    ).where("sequence_id IS NOT NULL AND _t IS NOT NULL AND _item IS NOT NULL")
    elements = (
        rows.distinct()
        .groupBy("sequence_id", "_t")
        .agg(F.sort_array(F.collect_list("_item")).alias("items"))
    )
    return number_rows(elements, ["sequence_id"], "_t", [], hot_rows, sizing=rows).select(
        "sequence_id", "position", "items"
    )


def events(
    df: DataFrame,
    key: str,
    item: str,
    time: str,
    tiebreak: str,
    null_items: str = "drop",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row is a one-item element; a null time sorts last."""
    require_columns(df, key, item, time, tiebreak)
    rows = df.select(
        F.col(key).alias("sequence_id"),
        F.col(time).alias("_t"),
        F.col(tiebreak).alias("_tie"),
        item_text(item, null_items).alias("_item"),
    ).where("sequence_id IS NOT NULL AND _item IS NOT NULL")
    return number_rows(rows, ["sequence_id"], "_t", ["_tie"], hot_rows).select(
        "sequence_id", "position", F.array("_item").alias("items")
    )


def sessions(
    df: DataFrame,
    user: str,
    item: str,
    time: str,
    tiebreak: str,
    gap_minutes: float = 30,
    null_items: str = "drop",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Event elements cut into sessions; adds ``user_id`` and ``session`` and names the sequence ``user_n``."""
    require_columns(df, user, item, time, tiebreak)
    rows = df.select(
        F.col(user).alias("user_id"),
        F.col(time).alias("_t"),
        F.col(tiebreak).alias("_tie"),
        item_text(item, null_items).alias("_item"),
    ).where("user_id IS NOT NULL AND _item IS NOT NULL")
    numbered, any_hot = number_sessions(rows, ["user_id"], "_t", ["_tie"], gap_minutes, hot_rows)
    # user_id and session rather than the name: the rows already lie by user_id
    placed = number_rows(numbered, ["user_id", "session"], "_t", ["_tie"], hot_rows, any_hot=any_hot)
    name = F.concat_ws("_", F.col("user_id").cast("string"), F.col("session").cast("string"))
    return placed.select(name.alias("sequence_id"), "user_id", "session", "position", F.array("_item").alias("items"))


def by_transaction(
    df: DataFrame, key: str, transaction: str, item: str, time: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One element per transaction, ordered by the transaction's first time, then its id."""
    rows = clean_rows(df, key, item, time).where(F.col(transaction).isNotNull())
    # written once: the sizes of the keys, the row numbers and every reader start from it, not from the joins before it
    elements = durable(
        rows.groupBy(F.col(key).alias("sequence_id"), F.col(transaction).alias("_txn"))
        .agg(F.min(time).alias("_t"), F.sort_array(F.collect_set(F.col(item))).alias("items"))
    )
    return number_rows(elements, ["sequence_id"], "_t", ["_txn"], hot_rows).select(
        "sequence_id", "position", "items"
    )


def custom(df: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A caller's own builder; it must return ``sequence_id``, ``position`` and ``items``. Null items are dropped."""
    out = df.transform(build)
    require_columns(out, "sequence_id", "position", "items")
    return out.select(
        "sequence_id", F.col("position").cast("bigint").alias("position"), 
        F.sort_array(F.array_distinct(F.filter("items", lambda i: i.isNotNull()))).alias("items"),
    ).where(F.size("items") > 0)


def assemble(elements: DataFrame) -> DataFrame:
    """Nested form: ``(sequence_id, elements array<array<..>>)``, one row per sequence."""
    parts = F.sort_array(F.collect_list(F.struct("position", "items")))
    return elements.groupBy("sequence_id").agg(F.transform(parts, lambda p: p["items"]).alias("elements"))


def dense_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """1-based index in the order of ``column`` (unique values), without a single-task sort.

    Range-partition, sort each part, keep that layout, then add the sizes of the earlier parts.
    """
    laid_out = durable(df.repartitionByRange(column).sortWithinPartitions(column))
    placed = laid_out.withColumn("_part", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row") + 1)
        .drop("_part", "_row", "_start")
    )


def item_dictionary(items: DataFrame) -> DataFrame:
    """``(item, item_id)`` with 1-based ids in sorted item order, for a table with an ``item`` column."""
    return dense_index(items.where("item IS NOT NULL").select("item").distinct(), "item", "item_id")


def explode_items(elements: DataFrame) -> DataFrame:
    return elements.select("sequence_id", "position", F.explode("items").alias("item"))


def encode(elements: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Items to ids, sorted within the element."""
    return (
        explode_items(elements)
        .join(dictionary, "item")
        .groupBy("sequence_id", "position")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )


def decode(elements: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Ids back to items."""
    return (
        elements.select("sequence_id", "position", F.explode("items").alias("item_id"))
        .join(dictionary, "item_id")
        .groupBy("sequence_id", "position")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )


def shape(elements: DataFrame) -> DataFrame:
    """Per sequence: number of elements, total items and distinct items."""
    sizes = elements.groupBy("sequence_id").agg(
        F.count(F.lit(1)).alias("n_elements"), F.sum(F.size("items")).alias("n_items")
    )
    distinct = (
        explode_items(elements)
        .select("sequence_id", "item")
        .distinct()
        .groupBy("sequence_id")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )
    return sizes.join(distinct, "sequence_id")


def flatten(elements: DataFrame) -> DataFrame:
    """Items in sequence order, one row each."""
    return elements.select("sequence_id", "position", F.posexplode("items").alias("slot", "item"))


_LENGTH_BUCKETS = {
    "statistics": (("1", 1), ("2-5", 5), ("6-10", 10), (">10", None)),
    "performance": (("1", 1), ("2-5", 5), ("6-10", 10), ("11-20", 20), (">20", None)),
}


def length_histogram(elements: DataFrame, scheme: str = "performance") -> DataFrame:
    """Sequences per length bucket with percentage; empty buckets appear with 0."""
    lengths = elements.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("length"))
    buckets = _LENGTH_BUCKETS[scheme]
    name = F.lit(None).cast("string")
    for label, top in reversed(buckets):
        name = F.lit(label) if top is None else F.when(F.col("length") <= top, label).otherwise(name)
    counts = lengths.agg(*[F.count_if(name == label).alias(f"n{i}") for i, (label, _) in enumerate(buckets)],
                         F.count(F.lit(1)).alias("total"))
    rows = F.array(*[F.struct(F.lit(label).alias("bucket"), F.col(f"n{i}").alias("n"))
                     for i, (label, _) in enumerate(buckets)])
    return counts.select("total", F.inline(rows)).select(
        "bucket", "n", F.when(F.col("total") > 0, 100.0 * F.col("n") / F.col("total")).otherwise(0.0).alias("percent")
    )


def sequence_stats(elements: DataFrame) -> DataFrame:
    """Sequence count, length figures, items per element and totals, in one row."""
    per_sequence = elements.groupBy("sequence_id").agg(
        F.count(F.lit(1)).alias("length"), F.sum(F.size("items")).alias("items")
    )
    return per_sequence.agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.coalesce(F.avg("length"), F.lit(0.0)).alias("avg_events"),
        F.coalesce(F.min("length"), F.lit(0)).alias("min_events"),
        F.coalesce(F.max("length"), F.lit(0)).alias("max_events"),
        F.coalesce(F.try_divide(F.sum("items"), F.sum("length")), F.lit(0.0)).alias("avg_items_per_event"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_events"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_items"),
    )


def item_support(elements: DataFrame) -> DataFrame:
    """Sequences per item, counted once per sequence, with the share of all sequences."""
    once = explode_items(elements).select("sequence_id", "item").distinct()
    counted = once.groupBy("item").agg(F.count(F.lit(1)).alias("support_count"))
    total = elements.agg(F.countDistinct("sequence_id"))
    return counted.select("item", "support_count", (F.col("support_count") / total.scalar()).alias("support"))
