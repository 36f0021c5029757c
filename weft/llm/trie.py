"""Prefix trie of conversations: nodes by digests of prefixes, subtree sums by list-ranking an Euler tour.

Every node has an enter and an exit arc. The tour visits the children of a
node in the order of their smallest members, so arcs that follow one another
mostly lie in one range of (smallest member, depth). Each range is contracted
to a few segments inside its task, the segments are ranked by merging random
mates until few are left, and sums over a subtree are differences of prefix
sums at its two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.sequences import number_rows

from .common import stored

# Turns that are digested one after the other in a row; longer conversations take one more level per factor of it.
BLOCK = 64
# Turns of one conversation that meet what is known of the conversation in one task.
SLICE = 1024
# Nodes of a range that one task contracts.
NODES_PER_TASK = 250_000
# So many segments are ranked in one task.
FEW_SEGMENTS = 16_384
# Ids of conversations in one piece of text on the way to a node's digest.
IDS_PER_PIECE = 4096
# The longest borrowed beginning: lengths are remainders of a division by 9.
MOST_BORROWED = 8

def _nothing() -> Column:
    return F.lit(b"")


def _sha(column: Column) -> Column:
    return F.unhex(F.sha2(column, 256))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, turn_digest, bytes): the turns of each conversation, numbered from 0.

    Turns are in the order of ``turn``, null first; equal ones in the order of
    their digests. Null role or text is empty. Rows without conv_id belong to
    no conversation. A conversation with very many turns is numbered in slices.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"),
        _sha(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn_digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    numbered = number_rows(rows, ["conv_id"], "known", ["turn", "turn_digest"])
    return numbered.select("conv_id", (F.col("position") - 1).alias("n"), "turn_digest", "bytes")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations of ``own`` turns: their turns (conv_id, d from 1, turn_digest, bytes, last), and all conv_ids with their
    ``length``.

    The first h turns come from the conversation conv_id - conv_id % 5 (all if
    it has fewer, none if it is absent), then the conversation's own turns
    after its first h follow; h is crc32(conv_id as text) % 9.
    """
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("m"))
    convs = sizes.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    convs = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("m").alias("m_base")), "base", "left")
    convs = convs.withColumn("borrowed", F.least("h", F.coalesce("m_base", F.lit(0)))).drop("m_base")
    convs = stored(convs.withColumn("length", F.col("borrowed") + F.greatest(F.col("m") - F.col("h"), F.lit(0))), "conversations")
    heads = own.where(F.col("n") < MOST_BORROWED).withColumnRenamed("conv_id", "base")
    first = convs.join(heads, "base").where("n < h").select("conv_id", (F.col("n") + 1).alias("d"), "turn_digest", "bytes", "length")
    per_slice = convs.select(
        "conv_id", "h", "borrowed", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {SLICE}"))).alias("slice")
    )
    rest = own.withColumn("slice", F.expr(f"n div {SLICE}")).join(per_slice, ["conv_id", "slice"]).where("n >= h").select(
        "conv_id", (F.col("borrowed") + F.col("n") - F.col("h") + 1).alias("d"), "turn_digest", "bytes", "length"
    )
    both = first.unionByName(rest).select("conv_id", "d", "turn_digest", "bytes", (F.col("d") == F.col("length")).alias("last"))
    return both, convs.select("conv_id", "length")


def prefix_digests(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` (conv_id, d from 1 without gaps, turn_digest, bytes, last) with ``prefix`` and ``parent``: digests of the first d and d - 1
    turns of the conversation.

    Digests run on inside blocks of turns. Full blocks are the turns of a
    shorter list, whose digests stand for all that precedes a block, so no
    conversation is held whole, however long it is.
    """
    blocks = rows.groupBy("conv_id", F.expr(f"(d - 1) div {block}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("d", "turn_digest", "bytes", "last"))).alias("turns")
    )
    step = lambda done, t: F.concat(done, F.array(_sha(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), _nothing()), t["turn_digest"]))))
    blocks = stored(blocks.withColumn("run", F.aggregate("turns", F.array().cast("array<binary>"), step)), "blocks")
    before, through, run = F.lit(None).cast("binary"), F.lit(None).cast("binary"), F.col("run")
    if (blocks.agg(F.max("block")).first()[0] or 0) > 0:
        full = blocks.where(F.size("run") == block).select(
            "conv_id", (F.col("block") + 1).alias("d"), F.element_at("run", -1).alias("turn_digest"), F.lit(0).cast("long").alias("bytes"),
            F.lit(False).alias("last"),
        )
        above = stored(prefix_digests(full, block).select("conv_id", F.col("d").alias("block"), "prefix"), "block-digests")
        blocks = blocks.join(above.withColumnRenamed("prefix", "before"), ["conv_id", "block"], "left").join(
            above.select("conv_id", (F.col("block") - 1).alias("block"), F.col("prefix").alias("through")), ["conv_id", "block"], "left"
        )
        before, through = F.coalesce("before", _nothing()), F.col("through")
        run = F.transform("run", lambda x, i: F.when((i == block - 1) & through.isNotNull(), through).otherwise(_sha(F.concat(before, x))))
    each = blocks.select("conv_id", "turns", run.alias("run"), F.coalesce(before, _nothing()).alias("before"))
    each = each.select("conv_id", "turns", "run", "before", F.posexplode("run").alias("i", "prefix"))
    here = F.get("turns", F.col("i"))
    return each.select(
        "conv_id", here["d"].alias("d"), here["bytes"].alias("bytes"), here["last"].alias("last"), "prefix",
        F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("run", F.col("i") - 1)).alias("parent"),
    )


# -- list ranking -----------------------------------------------------------------------------------


def _contract(arcs: np.ndarray, after: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a part of a linked list, per arc: the index of the first arc of its segment, and the sums of weights from there up to
    the arc (without it); and which arcs end a segment. ``after`` has the next arc, -1 for none."""
    n = len(arcs)
    order = np.argsort(arcs, kind="stable")
    place = np.minimum(np.searchsorted(arcs[order], after), n - 1)
    nxt = order[place]
    inside = (after >= 0) & (arcs[nxt] == after)
    jump = np.arange(n)
    jump[nxt[inside]] = np.flatnonzero(inside)
    sums = np.zeros_like(weights)
    moved = jump != np.arange(n)
    sums[moved] = weights[jump[moved]]
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump, sums, ~inside
        sums += sums[jump]  # a first arc has sums of zero
        jump = further


_ARCS = "kind int, id long, head_in long, head_out long, leaf_in long, saved_in long, leaf_out long, saved_out long"


def _columns(batches: Iterator[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    parts = [[b.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in names] for b in batches if b.num_rows]
    return [np.concatenate(x).astype(np.int64) for x in zip(*parts)] if parts else [np.zeros(0, np.int64) for _ in names]


def _by_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes (id, next_in, next_out, leaf, saved) to a row per node with the sums at its arcs (kind 0) and a row per segment of the tour
    (kind 1: id is its first arc, head_in the arc after it, leaf_in and saved_in its sums)."""
    ids, next_in, next_out, leaf, saved = _columns(batches, ["id", "next_in", "next_out", "leaf", "saved"])
    n = len(ids)
    if not n:
        return
    arcs, after = np.concatenate([2 * ids, 2 * ids + 1]), np.concatenate([next_in, next_out])
    weights = np.zeros((2 * n, 2), np.int64)
    weights[:n, 0], weights[:n, 1] = leaf, saved
    first, sums, ends = _contract(arcs, after, weights)
    heads, tail = arcs[first], np.flatnonzero(ends)
    total, none = sums[tail] + weights[tail], pa.nulls(len(tail), pa.int64())
    names = [field.split()[0] for field in _ARCS.split(", ")]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, np.int32)), *(pa.array(x) for x in (ids, heads[:n], heads[n:], sums[:n, 0], sums[:n, 1], sums[n:, 0], sums[n:, 1]))], names
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(tail), np.int32)), pa.array(heads[tail]), pa.array(after[tail], mask=after[tail] < 0), none, pa.array(total[:, 0].copy()),
         pa.array(total[:, 1].copy()), none, none], names
    )


def _last_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, after, leaf, saved = _columns(batches, ["id", "next", "leaf", "saved"])
    if len(ids):
        _, sums, _ = _contract(ids, after, np.column_stack([leaf, saved]))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums[:, 0].copy()), pa.array(sums[:, 1].copy())], ["id", "leaf", "saved"])


def rank_segments(segments: DataFrame, few: int = FEW_SEGMENTS) -> DataFrame:
    """(id, leaf, saved): the sums of all segments before each, for a list of segments (id, next, leaf, saved).

    While more than ``few`` are left, a coin is thrown for each and round; a
    segment with heads after one with tails joins it, about a quarter of them
    a round. Those are given their place again in the reverse order.
    """
    current, gone, turn = stored(segments, "segments"), [], 0
    while current.count() > few:
        coin = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2))
        tails, heads = current.where(coin == 0), current.where(coin == 1)
        follower = heads.select(F.col("id").alias("f"), F.col("next").alias("f_next"), F.col("leaf").alias("f_leaf"), F.col("saved").alias("f_saved"))
        met = stored(tails.join(follower, F.col("next") == F.col("f"), "left"), "mates")
        gone.append(met.where("f IS NOT NULL").select(F.col("f").alias("id"), F.col("id").alias("into"), "leaf", "saved"))
        more = lambda c: (F.col(c) + F.coalesce(f"f_{c}", F.lit(0))).alias(c)
        merged = met.select("id", F.when(F.col("f").isNull(), F.col("next")).otherwise(F.col("f_next")).alias("next"), more("leaf"), more("saved"))
        current = stored(merged.unionByName(heads.join(gone[-1].select("id"), "id", "left_anti")), "segments")
        turn += 1
    placed = stored(current.coalesce(1).mapInArrow(_last_few, "id long, leaf long, saved long"), "placed")
    for lost in reversed(gone):
        at = placed.select(F.col("id").alias("into"), F.col("leaf").alias("b_leaf"), F.col("saved").alias("b_saved"))
        back = lost.join(at, "into").select("id", (F.col("leaf") + F.col("b_leaf")).alias("leaf"), (F.col("saved") + F.col("b_saved")).alias("saved"))
        placed = stored(placed.unionByName(back), "placed")
    return placed


# -- digests of the conversations that end at a node ----------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (prefix, d, conv_id) to texts of the ids of at most IDS_PER_PIECE conversations of a node."""
    for batch in batches:
        keys, depths, ids = (batch.column(c).to_pylist() for c in ("prefix", "d", "conv_id"))
        rows, start = [], 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or i - start == IDS_PER_PIECE or keys[i] != keys[start] or depths[i] != depths[start]:
                rows.append((keys[start], depths[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64(), pa.string()))], ["prefix", "d", "first", "ids"]
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (prefix, d, first) to a digest per node; pieces are fed to it one by one."""
    key, sha = None, None
    for batch in batches:
        done = []
        for prefix, d, ids in zip(*(batch.column(c).to_pylist() for c in ("prefix", "d", "ids"))):
            if key == (prefix, d):
                sha.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((*key, sha.hexdigest()))
            key, sha = (prefix, d), hashlib.sha256(ids.encode())
        yield _ends_batch(done)
    yield _ends_batch([] if key is None else [(*key, sha.hexdigest())])


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.binary(), pa.int64(), pa.string()))], ["prefix", "d", "ends"])


def _ends(ends: DataFrame) -> DataFrame:
    """(prefix, d, ends): SHA-256 of the ascending conv_ids of each node's (prefix, d, conv_id), joined by commas.

    Texts of the ids are put together by ranges, so also for a node at which
    very many conversations end; its digest itself can only be taken in one
    go, but over few long pieces that stream through.
    """
    spark = ends.sparkSession
    rows = stored(ends, "ends")
    ranged = rows.repartitionByRange("prefix", "d", "conv_id").sortWithinPartitions("prefix", "d", "conv_id")
    pieces = stored(ranged.mapInArrow(_pieces, "prefix binary, d long, first long, ids string"), "end-pieces")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(n, "prefix", "d").sortWithinPartitions("prefix", "d", "first").mapInArrow(_digests, "prefix binary, d long, ends string")


# -- the trie -------------------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, block: int = BLOCK, nodes_per_task: int = NODES_PER_TASK, few: int = FEW_SEGMENTS) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    Conversations are rebuilt as in ``rebuilt``; each distinct sequence of
    their first d turns (role and text) is a node of depth d, from the root of
    all conversations. saved_tokens sums, over the node's subtree, (n_convs - 1)
    * UTF-8 bytes of the last text; ends_sha256 is taken of the conv_ids that
    end there. A conversation without turns ends at the root. Null turns come
    first, null roles and texts are empty, rows that repeat are turns of their
    own, rows without conv_id take no part; an empty table, or one without any
    conv_id, gives no rows; other columns are ignored. Texts are only read to be
    digested, so their length does not matter.
    """
    own = stored(turns(conversations), "turns")
    rows, convs = rebuilt(own)
    members = stored(prefix_digests(rows, block), "prefixes")
    inner = members.groupBy("d", "prefix").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("parent").alias("parent"), F.max("bytes").alias("bytes")
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("d"), _nothing().alias("prefix"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("bytes"),
    )
    found = stored(inner.unionByName(root), "found-nodes")
    parts = max(1, -(-found.count() // nodes_per_task))
    ranged = found.repartitionByRange(parts, "conv_id", "d").sortWithinPartitions("conv_id", "d")
    nodes = stored(ranged.withColumn("id", F.monotonically_increasing_id()).withColumn("slice", F.spark_partition_id()), "nodes")

    # children of a node, by range: a node with very many has a row per range, not per child
    pieces = nodes.where("d > 0").groupBy("parent", "d", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    above = nodes.select(F.col("prefix").alias("parent"), (F.col("d") + 1).alias("d"), F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    pieces = stored(pieces.join(above, ["parent", "d"]), "pieces")
    next_piece = F.lead("first").over(Window.partitionBy("parent_id").orderBy("slice"))
    sibling = F.lead("id").over(Window.partitionBy("parent", "d", "slice").orderBy("id"))
    children = nodes.where("d > 0").withColumn("sibling", sibling).join(
        pieces.withColumn("next_piece", next_piece).drop("n", "first"), ["parent", "d", "slice"]
    )
    next_out = F.coalesce(2 * F.coalesce("sibling", "next_piece"), 2 * F.col("parent_id") + 1)
    linked = children.select("id", "conv_id", "d", "prefix", "n_convs", "bytes", "parent_conv_id", next_out.alias("next_out")).unionByName(
        nodes.where("d = 0").select(
            "id", "conv_id", "d", "prefix", "n_convs", "bytes", F.lit(None).cast("long").alias("parent_conv_id"), F.lit(None).cast("long").alias("next_out")
        )
    )
    families = pieces.groupBy(F.col("parent_id").alias("id")).agg(F.sum("n").alias("n_children"), F.min("first").alias("first_child"))
    linked = stored(
        linked.join(families, "id", "left").select(
            "id", "conv_id", "d", "prefix", "n_convs", "parent_conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce(2 * F.col("first_child"), 2 * F.col("id") + 1).alias("next_in"), "next_out",
            F.col("first_child").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        ),
        "links",
    )
    tour = stored(
        linked.select("id", "next_in", "next_out", "leaf", "saved").repartitionByRange(parts, "id").mapInArrow(_by_ranges, _ARCS), "tour"
    )
    segments = tour.where("kind = 1").select("id", F.col("head_in").alias("next"), F.col("leaf_in").alias("leaf"), F.col("saved_in").alias("saved"))
    at = rank_segments(segments, few)
    # sums at both arcs of a node count from the same place if they are in one segment
    arcs = tour.where("kind = 0").drop("kind")
    side = lambda x: at.select(F.col("id").alias(f"head_{x}"), F.col("leaf").alias(f"b_leaf_{x}"), F.col("saved").alias(f"b_saved_{x}"))
    far = arcs.where("head_in <> head_out").join(side("in"), "head_in").join(side("out"), "head_out")
    sums = far.select(
        "id", (F.expr("b_leaf_out + leaf_out - b_leaf_in - leaf_in")).alias("n_leaves"), (F.expr("b_saved_out + saved_out - b_saved_in - saved_in")).alias("saved_tokens")
    ).unionByName(
        arcs.where("head_in = head_out").select("id", (F.col("leaf_out") - F.col("leaf_in")).alias("n_leaves"), (F.col("saved_out") - F.col("saved_in")).alias("saved_tokens"))
    )
    ending = members.where("last").select("prefix", "d", "conv_id").unionByName(
        convs.where("length = 0").select(_nothing().alias("prefix"), F.lit(0).cast("long").alias("d"), "conv_id")
    )
    out = linked.join(sums, "id").join(stored(_ends(ending), "end-digests"), ["prefix", "d"], "left")
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
