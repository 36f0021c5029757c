"""K-d tree sharding: byte-weighted medians along the widest metadata dimension. Native expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.runtime import small_side

from .common import UID, stored

DIMS = ("source", "lang", "length")
BITS = 20  # of a coordinate
TIE = 63 - BITS
ROW = 21  # bits of a key that tell the rows of a group of copies apart
# A key of 63 bits is narrowed down to the bits from here on, pass by pass; one pass ends at the groups of copies.
STEPS = (50, 37, 24, ROW, 8, 0)
# A group of copies of up to this share of a shard is not divided.
WHOLE_SHARE = 0.02
SALTS = 16
SLOT_ROWS = 4096


def _category(name: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(name)), 64 - BITS)


def _coordinates(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + F.lit(1)).cast("long")
    return docs.select(
        F.monotonically_increasing_id().alias(UID), F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _category("source").alias("source"), _category("lang").alias("lang"),
        F.least(F.lit(2**BITS - 1), (F.log2(size) * F.lit(2**BITS / 48)).cast("long")).alias("length"), F.xxhash64(text).alias("copies"),
    )


def _one_point(placed: DataFrame) -> DataFrame:
    """Equal texts at one point, that of the copy with the smallest doc_id, and the ``tie``: a hash of the text, then of the row.

    Only the groups whose copies differ are joined, along salts, as a group may be very large.
    """
    point = F.struct("source", "lang")
    groups = placed.groupBy("copies").agg(
        F.min_by(point, F.struct("doc_id", UID)).alias("point"), F.min(point).alias("least"), F.max(point).alias("most")
    )
    apart = groups.where("least <> most").select("copies", "point", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = placed.withColumn("salt", F.pmod(F.xxhash64(F.lit("copy"), F.col(UID)), F.lit(SALTS)).cast("int")).join(apart, ["copies", "salt"], "left")
    tie = F.shiftleft(F.shiftrightunsigned("copies", 64 - TIE + ROW), ROW).bitwiseOR(
        F.shiftrightunsigned(F.xxhash64(F.lit("tie"), F.col(UID)), 64 - ROW)
    )
    return met.select(
        UID, "doc_id", "size", "text_crc32", "length", tie.alias("tie"),
        *[F.coalesce(F.col(f"point.{d}"), F.col(d)).alias(d) for d in ("source", "lang")],
    )


def _keyed(level: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """The rows of nodes that are to be cut, with their ``key`` along the node's widest dimension, and a row per node with its ``goal``."""
    wide = F.array(*[(F.max(d) - F.min(d)).alias(d) for d in DIMS])
    nodes = level.where("k > 1").groupBy("node", "k").agg(F.sum("size").alias("bytes"), wide.alias("wide"))
    nodes = stored(nodes.select(
        "node", F.array_position("wide", F.array_max("wide")).cast("int").alias("dim"),
        (F.col("bytes") * F.expr("k div 2") / F.col("k")).alias("goal"), (F.col("bytes") / F.col("k") * WHOLE_SHARE).alias("whole"),
    ), "kd")
    coordinate = F.element_at(F.array(*DIMS), F.col("dim"))
    key = F.shiftleft(coordinate, TIE).bitwiseOR(F.col("tie"))
    return level.join(small_side(nodes.select("node", "dim"), shards), "node").withColumn("key", key).drop("dim"), nodes


def _cuts(keyed: DataFrame, nodes: DataFrame, shards: int) -> DataFrame:
    """``(node, cut)``: the key up to which rows go left, so that the bytes on the left come nearest to the goal.

    Each pass adds bytes by some more bits of the keys inside the range still
    open, up to 8,192 sums a node, and goes on in the part that reaches the
    goal. Where that part is one group of copies of at most ``whole`` bytes,
    the cut is the border of the group that is nearer to the goal.
    """
    state = nodes.select("node", "goal", "whole", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("long").alias("cut"))
    last = 63
    in_order, all_of = Window.partitionBy("node").orderBy("part"), Window.partitionBy("node")
    for shift in STEPS:
        # every key begins with the prefix 0 of its 63rd bit, which is never set
        opened = keyed.select("node", "key", "size").join(small_side(state.where("cut IS NULL").select("node", "prefix"), shards), "node")
        opened = opened.where(F.shiftright("key", last) == F.col("prefix"))
        sums = opened.groupBy("node", F.shiftright("key", shift).alias("part")).agg(F.sum("size").alias("bytes"))
        run = sums.join(small_side(state, shards), "node").withColumn("upto", F.col("below") + F.sum("bytes").over(in_order))
        reached = run.withColumn("end", F.max("part").over(all_of)).where("upto >= goal OR part = end")
        first = reached.groupBy("node").agg(F.min_by(F.struct(*[c for c in reached.columns if c != "node"]), "part").alias("s")).select("node", "s.*")
        nearer = (F.abs(F.col("upto") - F.col("goal")) <= F.abs(F.col("upto") - F.col("bytes") - F.col("goal"))).cast("long")
        border = F.shiftleft(F.col("part") + nearer, shift) - 1
        cut = F.when(F.lit(shift == 0) | (F.lit(shift == ROW) & (F.col("bytes") <= F.col("whole"))), border)
        moved = first.select("node", "goal", "whole", (F.col("upto") - F.col("bytes")).alias("below"), F.col("part").alias("prefix"), cut.alias("cut"))
        state = stored(moved.unionByName(state.where("cut IS NOT NULL")), "kd")
        last = shift
    return state.select("node", "cut")


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Deal the rows of ``docs`` over k-d tree leaves of nearly equal bytes.

    The space has three metadata dimensions (source, lang, log of the size).
    Every node that is to hold k > 1 leaves is cut along its widest dimension
    at the byte-weighted k//2 : k - k//2 quantile, until leaves reach the
    target: ``shards`` leaves, or as many as ``target_bytes`` needs. Equal
    texts are at one point, the metadata of the one with the smallest doc_id.
    Ties in a dimension are ordered by a hash of the text and then of the row,
    and cuts are made between groups of equal texts, so that a group stays
    together; only one of more than WHOLE_SHARE of a leaf's bytes may be
    divided, where a cut falls on it.

    Returns doc_id, size (UTF-8 bytes + 1; null text has none), text_crc32,
    shard and slot (gapless from 0 within the shard). Null metadata is a
    category of its own; repeated rows are placed one by one; very long texts
    weigh their bytes and are never cut; an empty table gives no rows; other
    columns are ignored.
    """
    level = _one_point(stored(_coordinates(docs), "kd"))
    total = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1)).first()[0] or 0 if shards is None else 0
    shards = shards or max(1, math.ceil(total / (target_bytes or 1 << 28)))
    # a node is named by the first of its k leaves
    level = stored(level.withColumn("node", F.lit(0)).withColumn("k", F.lit(shards)), "kd")
    for _ in range(math.ceil(math.log2(shards))):
        keyed, nodes = _keyed(level, shards)
        cut = keyed.join(small_side(_cuts(keyed, nodes, shards), shards), "node")
        left = F.expr("k div 2").cast("int")
        right = F.col("key") > F.col("cut")
        halves = cut.withColumn("node", F.col("node") + F.when(right, left).otherwise(0)).withColumn("k", F.when(right, F.col("k") - left).otherwise(left))
        level = stored(halves.select(*level.columns).unionByName(level.where("k = 1")), "kd")
    return number_slots(level.select("doc_id", UID, "size", "text_crc32", F.col("node").alias("shard")), shards)


def number_slots(placed: DataFrame, shards: int) -> DataFrame:
    """Add the slot: offsets of hashed blocks of some thousand rows, then row numbers within a block."""
    blocks = max(1, math.ceil(placed.count() / (SLOT_ROWS * shards)))
    blocked = placed.withColumn("block", F.pmod(F.xxhash64(F.lit("slot"), F.col(UID)), F.lit(blocks)))
    counts = blocked.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "shard", "block",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("shard", "block").orderBy(UID)) - 1
    return blocked.withColumn("place", place).join(small_side(before, blocks * shards), ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).alias("slot")
    )
