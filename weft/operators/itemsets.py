"""Frequent-itemset miners over baskets ``(tid, items)``.

The three miners count in three ways:

* Apriori is horizontal: a basket yields its pairs of frequent items, and from
  level 3 only pairs that start a candidate, whose other items are looked up
  in the basket.
* Eclat is vertical: an itemset is a set of 64-bit masks, one per block of 64
  baskets that has any of its baskets; an itemset grows by the AND of two.
* FP-Growth is MLlib's.

Equal baskets are merged before anything is counted. Pairs are counted from the baskets by Apriori and Eclat alike, so the number of
items does not matter, only the pairs that occur. Counts are summed map-side,
so a level shuffles at most one row per candidate and task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import min_count, mllib_support
from ..runtime import cached, durable, require_columns, small_side
from .baskets import count_items
from .sequences import dense_index

# Baskets per counting partition key; 64 blocks of 64.
BASKETS_PER_CELL = 4096
# A basket's pairs are formed in tiles of so many items by as many.
TILE = 512
# With at most so many frequent items a basket is coded within its row.
ROW_ITEMS = 256
# Binary digits of the number of equal baskets.
PLANES = 64


@dataclass
class Encoded:
    """Baskets reduced to frequent items, with the threshold that was applied."""

    n: int
    threshold: int
    dictionary: DataFrame  # item, id (0-based), support_count
    n_items: int
    merged: DataFrame  # items, n: equal baskets are one row


def encode(baskets: DataFrame, min_support: float, by_support: bool = False) -> Encoded:
    """Merge equal baskets in one pass, count items, keep the frequent ones and number them by name or by ascending support.

    Every row is a basket of its own, whatever its tid.
    """
    require_columns(baskets, "tid", "items")
    merged = durable(baskets.groupBy("items").agg(F.count(F.lit(1)).alias("n")))
    counted = durable(count_items(merged, "n"))
    total = counted.where("whole").first()
    n = total["support_count"] if total else 0
    threshold = min_count(min_support, n)
    frequent = counted.where(f"NOT whole AND item IS NOT NULL AND support_count >= {threshold}").drop("whole")
    placed = frequent.withColumn("order", F.struct("support_count", "item") if by_support else F.col("item"))
    dictionary = durable(
        dense_index(placed, "order", "id").select("item", (F.col("id") - 1).cast("int").alias("id"), "support_count")
    )
    return Encoded(n, threshold, dictionary, dictionary.count(), merged)


def reduced_baskets(enc: Encoded) -> DataFrame:
    """``(ids, n)``: the sorted ids of a basket's frequent items, where it has two or more, and how many baskets have just these."""
    ids = enc.dictionary.select("item", "id")
    if enc.n_items <= ROW_ITEMS:
        named = ids.agg(F.map_from_entries(F.collect_list(F.struct("item", "id"))).alias("named"))
        coded = F.transform("items", lambda i: F.element_at("named", i.cast("string")))
        held = enc.merged.crossJoin(F.broadcast(named)).select(F.filter(coded, lambda i: i.isNotNull()).alias("ids"), "n")
    else:
        each = enc.merged.withColumn("row", F.monotonically_increasing_id()).select("row", "n", F.explode("items").alias("item"))
        coded = each.withColumn("item", F.col("item").cast("string")).join(small_side(ids, enc.n_items), "item")
        held = coded.groupBy("row").agg(F.collect_list("id").alias("ids"), F.max("n").alias("n"))
    return held.where(F.size("ids") > 1).groupBy(F.sort_array("ids").alias("ids")).agg(F.sum("n").alias("n"))


def _basket_pairs(reduced: DataFrame) -> DataFrame:
    """``(i1, i2, ids, n)``: the pairs ``i1 < i2`` of each basket, with the basket; ``n`` is 1 where the baskets have none.

    A basket of more than TILE items is cut into tiles of TILE x TILE pairs,
    which are dealt over a fixed number of tasks: tiles are small, their pairs
    are not, so they are not to be put together by their bytes. A tile is sent
    as its two runs of items: to count its pairs a basket of n items sends
    n * n / TILE items.
    """
    tasks = int(reduced.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reduced = reduced.select("ids", "n" if "n" in reduced.columns else F.lit(1).cast("bigint").alias("n"))
    short = reduced.where(F.size("ids") <= TILE)
    first = short.select("ids", "n", F.posexplode("ids").alias("at", "i1"))
    near = first.select("i1", F.explode(F.slice("ids", F.col("at") + 2, F.size("ids"))).alias("i2"), "ids", "n")
    runs = reduced.where(F.size("ids") > TILE).withColumn("runs", F.expr(f"cast((size(ids) - 1) div {TILE} AS int)"))
    tiles = runs.select("ids", "n", "runs", F.explode(F.expr("sequence(0, runs)")).alias("a"))
    tiles = tiles.select("ids", "n", "a", F.explode(F.expr("sequence(a, runs)")).alias("b"))
    run = lambda at: F.slice("ids", F.col(at) * TILE + 1, F.lit(TILE))
    dealt = tiles.select(run("a").alias("left"), run("b").alias("right"), "ids", "n", F.xxhash64("ids", "a", "b").alias("to")).repartition(tasks, "to")
    far = dealt.select(F.explode("left").alias("i1"), "right", "ids", "n").select("i1", F.explode("right").alias("i2"), "ids", "n")
    return near.unionByName(far.where("i1 < i2"))


def count_pairs(reduced: DataFrame) -> DataFrame:
    """Support of every pair of items that occurs in a basket."""
    return _basket_pairs(reduced).groupBy("i1", "i2").agg(F.sum("n").alias("support_count"))


def count_candidates(reduced: DataFrame, candidates: DataFrame, k: int, rows: int) -> DataFrame:
    """Support of the candidates ``i1 < .. < ik``, k > 2, met through their first two items."""
    ids = [f"i{j}" for j in range(1, k + 1)]
    held = _basket_pairs(reduced).join(small_side(candidates.select(*ids), rows), ["i1", "i2"])
    for i in ids[2:]:
        held = held.where(F.array_contains("ids", F.col(i)))
    return held.groupBy(*ids).agg(F.sum("n").alias("support_count"))


def by_planes(reduced: DataFrame) -> DataFrame:
    """``(tid, id, plane)``: merged baskets for ``tid_masks``, once per binary digit of how many there are; ``tid`` is the basket."""
    planes = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda b: F.expr("n").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), b)) != 0)
    return reduced.select("ids", F.explode(planes).alias("plane")).select(F.col("ids").alias("tid"), F.explode("ids").alias("id"), "plane")


def tid_masks(coded: DataFrame, n: int) -> DataFrame:
    """``(cell, block, x, mask)``: which of a block's 64 baskets hold item ``x``.

    A basket's cell and bit depend only on its tid and its cell mates, so a
    recomputed task rebuilds the same masks. With a ``plane`` p every bit of a
    cell stands for 2**p equal baskets; p is the cell modulo PLANES.
    """
    cells = max(1, n // BASKETS_PER_CELL)
    plane = F.col("plane") if "plane" in coded.columns else F.lit(0)
    in_cell = Window.partitionBy("cell").orderBy("tid")
    return (
        coded.withColumn("cell", F.pmod(F.xxhash64("tid"), F.lit(cells)) * PLANES + plane)
        .withColumn("r", F.dense_rank().over(in_cell) - 1)
        .groupBy("cell", F.expr("r div 64").alias("block"), F.col("id").alias("x"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(r % 64 AS int))")).alias("mask"))
    )


def _extend(level: DataFrame, alive: int, k: int) -> DataFrame:
    """Join (k-1)-itemsets that share their first k-2 items."""
    shared = [f"i{j}" for j in range(1, k - 1)]
    left = level.select(*shared, f"i{k - 1}")
    right = level.select(*shared, F.col(f"i{k - 1}").alias(f"i{k}"))
    return left.join(small_side(right, alive), shared).where(f"i{k - 1} < i{k}")


def _prune(candidates: DataFrame, level: DataFrame, alive: int, k: int) -> DataFrame:
    """Keep candidates whose (k-1)-subsets are all frequent; the two join parents already are."""
    ids = [f"i{j}" for j in range(1, k + 1)]
    out = candidates
    for dropped in range(k - 2):
        rest = [i for j, i in enumerate(ids) if j != dropped]
        known = level.select(*[F.col(f"i{j + 1}").alias(i) for j, i in enumerate(rest)])
        out = out.join(small_side(known, alive), rest, "left_semi")
    return out


def _decode(levels: DataFrame, enc: Encoded) -> DataFrame:
    """Id sets to the canonical itemset table."""
    named = (
        levels.select("ids", "support_count", F.explode("ids").alias("id"))
        .join(small_side(enc.dictionary.select("id", "item"), enc.n_items), "id")
        .groupBy("ids", "support_count")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    return named.select(
        "items",
        F.size("items").alias("size"),
        "support_count",
        (F.col("support_count") / F.lit(float(max(enc.n, 1)))).alias("support"),
    )


def _id_rows(level: DataFrame, k: int) -> DataFrame:
    return level.select(F.array(*[f"i{j}" for j in range(1, k + 1)]).alias("ids"), "support_count")


def apriori(baskets: DataFrame, min_support: float = 0.01, max_len: int | None = None) -> DataFrame:
    """Level-wise: join, prune by all subsets, count in the baskets."""
    enc = encode(baskets, min_support)
    reduced = durable(reduced_baskets(enc)) if enc.n_items > 1 and max_len != 1 else None
    found, k = _id_rows(enc.dictionary.select(F.col("id").alias("i1"), "support_count"), 1), 2
    alive = enc.n_items
    level = None
    while reduced is not None and alive >= k and (max_len is None or k <= max_len):
        if k == 2:
            counted = count_pairs(reduced)
        else:
            candidates = durable(_prune(_extend(level, alive, k), level, alive, k))
            n_candidates = candidates.count()
            if n_candidates == 0:
                break
            counted = count_candidates(reduced, candidates, k, n_candidates)
        level = durable(counted.where(f"support_count >= {enc.threshold}"))
        alive = level.count()
        found = found.unionByName(_id_rows(level, k))
        k += 1
    return _decode(found, enc)


def eclat(baskets: DataFrame, min_support: float = 0.01, max_len: int | None = None) -> DataFrame:
    """Vertical: rarest items first, extend inside each prefix class, intersect TID masks.

    Pairs are counted in the baskets; the masks of the frequent ones start the
    prefix classes. ``p`` is the id of a prefix, of which each level keeps the
    masks of the frequent itemsets only.
    """
    enc = encode(baskets, min_support, by_support=True)
    wanted = enc.n_items > 1 and max_len != 1
    reduced = durable(reduced_baskets(enc)) if wanted else None
    masks = durable(tid_masks(by_planes(reduced), reduced.count())) if wanted and max_len != 2 else None
    found = _id_rows(enc.dictionary.select(F.col("id").alias("i1"), "support_count"), 1)
    if not wanted:
        return _decode(found, enc)
    level = durable(count_pairs(reduced).where(f"support_count >= {enc.threshold}"))
    alive, k = level.count(), 2
    found = found.unionByName(_id_rows(level, 2))
    states = None
    while alive > 1 and (max_len is None or k < max_len):
        # masks of the frequent k-itemsets, named by a dense id
        ids = [f"i{j}" for j in range(1, k + 1)]
        named = durable(dense_index(level.withColumn("set", F.array(*ids)), "set", "p"))
        if k == 2:
            pair = small_side(named.select("p", F.col("i1").alias("x"), "i2"), alive)
            grown = masks.join(pair, "x").select("p", "cell", "block", F.col("i2").alias("x"), F.col("mask").alias("other"))
        else:
            grown = states.join(small_side(named.select(F.col("from").alias("p"), F.col("p").alias("to"), F.col(ids[-1]).alias("x")), alive), "p")
            grown = grown.select(F.col("to").alias("p"), "cell", "block", "x", F.col("mask").alias("other"))
        both = grown.join(masks, ["cell", "block", "x"]).withColumn("mask", F.col("mask").bitwiseAND(F.col("other")))
        states = durable(both.where("mask <> 0").select("p", "cell", "block", "mask"))
        left, right = named.select("p", *ids), named.select(*ids[:-1], F.col(ids[-1]).alias(f"i{k + 1}"), F.col("p").alias("q"))
        joined = left.join(small_side(right, alive), ids[:-1]).where(f"i{k} < i{k + 1}")
        candidates = durable(joined)
        n_candidates = candidates.count()
        if n_candidates == 0:
            break
        # an itemset of the class differs from p in its last item only: AND of the two itemsets' masks
        mine = states.join(small_side(candidates.select("p", "q"), n_candidates), "p")
        met = mine.join(states.select(F.col("p").alias("q"), "cell", "block", F.col("mask").alias("other")), ["q", "cell", "block"])
        both = F.bit_count(F.col("mask").bitwiseAND(F.col("other"))).cast("bigint")
        weight = F.expr(f"shiftleft(1L, cast(cell % {PLANES} AS int))")
        counted = met.groupBy("p", "q").agg(F.sum(both * weight).alias("support_count"))
        frequent = counted.where(f"support_count >= {enc.threshold}")
        level = durable(
            frequent.join(small_side(candidates, n_candidates), ["p", "q"]).select(*ids, f"i{k + 1}", F.col("p").alias("from"), "support_count")
        )
        alive, k = level.count(), k + 1
        found = found.unionByName(_id_rows(level, k))
    return _decode(found, enc)


def _paths(bases: DataFrame) -> DataFrame:
    """From (ids, path, n) the conditional base of each set with one more item of the path: what comes after it, equal paths merged."""
    each = bases.select("ids", "n", "path", F.posexplode("path").alias("at", "x"))
    after = each.select(F.concat("ids", F.array("x")).alias("ids"), F.slice("path", F.col("at") + 2, F.size("path")).alias("path"), "n")
    return after.where(F.size("path") > 0).groupBy("ids", "path").agg(F.sum("n").alias("n"))


def _fpgrowth_bounded(enc: Encoded, max_len: int) -> DataFrame:
    """FP-Growth to a length: conditional pattern bases as rows (ids of the set, path, n) instead of trees.

    Ids rise with support, so a path holds the items more frequent than the
    set's. It is cut to the items that are frequent in the base of its set
    before the next one is made, and none is made for the last length.
    """
    found = enc.dictionary.select(F.array("id").alias("ids"), "support_count")
    nothing = F.array().cast("array<int>")
    bases = reduced_baskets(enc).select(F.col("ids").alias("path"), "n", nothing.alias("ids"))
    for k in range(2, max_len + 1):
        bases = durable(_paths(bases))
        counted = bases.select("ids", "n", F.explode("path").alias("x")).groupBy("ids", "x").agg(F.sum("n").alias("support_count"))
        level = durable(counted.where(f"support_count >= {enc.threshold}"))
        found = found.unionByName(level.select(F.concat("ids", F.array("x")).alias("ids"), "support_count"))
        if k == max_len or not level.limit(1).count():
            break
        able = level.groupBy("ids").agg(F.collect_set("x").alias("able"))
        bases = bases.join(able, "ids").select("ids", F.array_intersect("path", "able").alias("path"), "n")
    return _decode(found, enc)


def _transactions(reduced: DataFrame, n: int, parts: int) -> DataFrame:
    """One row per basket again, for MLlib: equal ones come together, so trees stay small, but a common one in pieces."""
    piece = max(1, n // (parts * 8))
    pieces = reduced.select("ids", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {piece})")).alias("piece"))
    dealt = pieces.repartition(parts, "ids", "piece").sortWithinPartitions("ids")
    left = f"least({piece}, n - piece * {piece})"
    return dealt.select("ids", F.explode(F.expr(f"array_repeat(1, cast({left} AS int))"))).select("ids")


def _fpgrowth(enc: Encoded, max_len: int | None) -> DataFrame:
    if max_len is not None and enc.n_items > 1 and max_len > 1:
        return _fpgrowth_bounded(enc, max_len)
    singles = enc.dictionary.select(F.array("id").alias("ids"), "support_count")
    if enc.n_items < 2 or max_len == 1:
        return _decode(singles, enc)
    # single-item baskets add nothing beyond the item counts already known
    reduced = durable(reduced_baskets(enc))
    n = reduced.agg(F.sum("n")).first()[0] or 0
    if n < enc.threshold:
        return _decode(singles, enc)
    conf = reduced.sparkSession.conf
    parts = max(reduced.sparkSession.sparkContext.defaultParallelism, int(conf.get("spark.sql.shuffle.partitions")))
    with cached(_transactions(reduced, n, parts)) as held:
        model = FPGrowth(
            itemsCol="ids", minSupport=mllib_support(enc.threshold, n), minConfidence=1.0, numPartitions=parts
        ).fit(held)
        longer = durable(
            model.freqItemsets.where(F.size("items") > 1).select(
                F.sort_array("items").alias("ids"), F.col("freq").alias("support_count")
            )
        )
    return _decode(singles.unionByName(longer), enc)


def fpgrowth(baskets: DataFrame, min_support: float = 0.01, max_len: int | None = None) -> DataFrame:
    """MLlib's parallel FP-Growth on id-coded baskets of frequent items; with ``max_len`` growth stops there, which MLlib cannot."""
    return _fpgrowth(encode(baskets, min_support, by_support=True), max_len)


ALGORITHMS = {"apriori": apriori, "fpgrowth": fpgrowth, "eclat": eclat}


def disagreements(results: dict[str, DataFrame]) -> DataFrame:
    """Itemsets (or patterns, see ``key``) not found with the same count by every algorithm; empty when all agree."""
    tagged = None
    for name, df in results.items():
        column = "items" if "items" in df.columns else "elements"
        part = df.select(F.col(column).alias("found"), "support_count", F.lit(name).alias("algorithm"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return (
        tagged.groupBy("found", "support_count")
        .agg(F.sort_array(F.collect_set("algorithm")).alias("algorithms"))
        .where(F.size("algorithms") < len(results))
    )
