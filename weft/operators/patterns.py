"""Sequential-pattern miners over sequence elements ``(sequence_id, position, items)``.

The miners count in three ways:

* GSP joins candidates with the sequences: the earliest position ``f`` at which
  a match of a prefix can end, one row per (prefix, sequence), meets the last
  position of the itemset that follows. The states of a prefix serve all
  candidates that begin with it. In a packed sequence (see below) a state is the
  mask of the positions after ``f`` and meets the masks of the itemsets.
* SPADE and CM-SPADE keep id-lists, the positions at which matches of a pattern
  end, as masks of 64 positions. Patterns are made of two siblings: AND of the
  masks, or the positions of one after the first of the other.
* PrefixSpan projects prefixes and counts what follows, without candidates.

All of them pack sequences whose positions are all below 64, if there are at
most PACKED_ITEMS frequent items: a row holds the masks of the siblings of one
class (PrefixSpan: the projections of one prefix's children and the masks of
the sequence's items), and a level is counted and grown row by row, with no
join of rows. Such a row is bounded by the number of frequent items (GSP: a row
holds the masks and states of the frequent patterns in one sequence). What only
the last level reads is counted as it is made and not laid out.
Longer sequences go the way of single rows; the counts of both are added.

Occurrences of an itemset are kept in chunks of 1024 positions, each with its
last position and the last one before it, so that the next occurrence after a
position is found in one chunk. No row grows with the sequence, no positions
are paired with each other and no sequence is held whole.

Frequent patterns carry integer ids, so states and occurrences stay narrow and
joins run on integers; a single item's pattern id is its item id. The small
pattern tables name patterns by text of their item ids, ``1,2>3``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import min_count
from ..runtime import durable, require_columns, small_side, with_rarest_item
from .sequences import dense_index, explode_items

CHUNK = 1024
# With more frequent items than this, no sequence is packed.
PACKED_ITEMS = 256
# Given patterns of more elements than this are matched by single rows; packed steps are made again for every length.
PACKED_STEPS = 4


def _name(elements: Column) -> Column:
    return F.array_join(F.transform(elements, lambda e: F.array_join(e.cast("array<string>"), ",")), ">")


def _last(elements: Column) -> Column:
    return F.element_at(elements, -1)


@dataclass
class EncodedSequences:
    n: int
    threshold: int
    dictionary: DataFrame  # item, id (1-based, item order), support_count
    n_items: int
    elements: DataFrame


def encode(elements: DataFrame, min_support: float) -> EncodedSequences:
    require_columns(elements, "sequence_id", "position", "items")
    once = explode_items(elements).groupBy("sequence_id", "item").agg(F.count(F.lit(1)).alias("times"))
    n = elements.select("sequence_id").distinct().count()
    threshold = min_count(min_support, n)
    dictionary = _dictionary(once, threshold)
    return EncodedSequences(n, threshold, dictionary, dictionary.count(), elements)


def _dictionary(once: DataFrame, threshold: int) -> DataFrame:
    """``(item, id, support_count)`` of the frequent items; ``once`` has a row per sequence and item."""
    frequent = once.groupBy("item").agg(F.count(F.lit(1)).alias("support_count")).where(f"support_count >= {threshold}")
    return durable(
        dense_index(frequent, "item", "id").select("item", F.col("id").cast("int").alias("id"), "support_count")
    )


def frequent_items(elements: DataFrame, min_support: float) -> DataFrame:
    """Items whose share of sequences reaches ``min_support``."""
    enc = encode(elements, min_support)
    return enc.dictionary.select(
        "item", "support_count", (F.col("support_count") / F.lit(float(max(enc.n, 1)))).alias("support")
    )


def _item_occurrences(positions: DataFrame) -> DataFrame:
    """Occurrences of single frequent items, chunked."""
    return _spans(
        positions.groupBy("x", "sequence_id", F.expr(f"position div {CHUNK}").alias("chunk")).agg(
            F.sort_array(F.collect_list("position")).alias("positions")
        )
    )


def _spans(chunks: DataFrame) -> DataFrame:
    """Chunks with their ``last`` position and the last one ``before`` them: the skip index of each (x, sequence)."""
    before = F.lag(F.element_at("positions", -1)).over(Window.partitionBy("sequence_id", "x").orderBy("chunk"))
    return chunks.withColumn("last", F.element_at("positions", -1)).withColumn("before", before)


def _step(states: DataFrame, chunks: DataFrame) -> DataFrame:
    """As-of join: ``f`` moves to the next occurrence of ``x``, which one chunk of ``_spans`` holds at most."""
    ends = F.col("f")
    here = (F.col("last") > ends) & (F.col("before").isNull() | (F.col("before") <= ends))
    after = F.get(F.filter("positions", lambda at: at > F.col("f")), F.lit(0))
    held = chunks.select("sequence_id", "x", "positions", "before", "last")
    return states.join(held, ["sequence_id", "x"]).where(here).withColumn("f", after).drop("positions", "before", "last")


def _first_states(occurrences: DataFrame) -> DataFrame:
    """Earliest end of the one-element pattern made of each itemset."""
    return occurrences.groupBy(F.col("x").alias("p"), "sequence_id").agg(
        F.min(F.element_at("positions", 1)).alias("f")
    )


def _intersect(occurrences: DataFrame, candidates: DataFrame, rows: int) -> DataFrame:
    """Occurrences of itemset ``grown`` with item ``b`` added, from the chunks of both; equal chunks only."""
    left = occurrences.join(small_side(candidates.select("grown", "b"), rows), F.col("x") == F.col("grown"))
    right = occurrences.select(
        F.col("x").alias("b"), "sequence_id", "chunk", F.col("positions").alias("_more")
    )
    return (
        left.drop("x", "last", "before")
        .join(right, ["sequence_id", "b", "chunk"])
        .select(
            "grown", "b", "sequence_id", "chunk",
            F.array_intersect("positions", "_more").alias("positions"),
        )
        .where(F.size("positions") > 0)
    )


def _last_ends(occurrences: DataFrame) -> DataFrame:
    """The last position of each itemset in each sequence."""
    return occurrences.groupBy("sequence_id", "x").agg(F.max("last").alias("last"))


def _count_after(states: DataFrame, ends: DataFrame, candidates: DataFrame, rows: int) -> DataFrame:
    """Support of the candidates ``q -> x``. States are unique per (pattern, sequence), so rows are sequences."""
    probes = states.select("sequence_id", F.col("p").alias("q"), "f").join(small_side(candidates.select("q", "x"), rows), "q")
    return (
        probes.join(ends, ["sequence_id", "x"])
        .where("last > f")
        .groupBy("q", "x")
        .agg(F.count(F.lit(1)).alias("support_count"))
    )


def _advance(states: DataFrame, occurrences: DataFrame, level: DataFrame, rows: int) -> DataFrame:
    """States of the pattern ``id = q -> x``: the first occurrence of ``x`` after the earliest end of ``q``."""
    left = states.join(small_side(level.select("id", F.col("q").alias("p"), "x"), rows), "p").drop("p")
    return _step(left, occurrences).select(F.col("id").alias("p"), "sequence_id", "f")


def _count_itemsets(grown_sets: DataFrame) -> DataFrame:
    """Sequences per new itemset."""
    once = grown_sets.select("grown", "b", "sequence_id").distinct()
    return once.groupBy("grown", "b").agg(F.count(F.lit(1)).alias("support_count"))


def _numbered(level: DataFrame, base: int) -> DataFrame:
    """Pattern ids after ``base``, in name order."""
    return dense_index(level, "name", "id").withColumn("id", (F.col("id") + base).cast("int"))


# -- candidate rules ------------------------------------------------------------------------------

_NEW, _SAME = "s", "i"  # last item opens a new element / joins the last element


def _append(elements: Column, item: Column, kind: str) -> Column:
    if kind == _NEW:
        return F.concat(elements, F.array(F.array(item)))
    return F.concat(
        F.slice(elements, F.lit(1), F.size(elements) - 1), F.array(F.concat(_last(elements), F.array(item)))
    )


def _drop_last(elements: Column) -> Column:
    head, last = F.slice(elements, F.lit(1), F.size(elements) - 1), _last(elements)
    shorter = F.concat(head, F.array(F.slice(last, F.lit(1), F.greatest(F.size(last) - 1, F.lit(0)))))
    return F.when(F.size(last) == 1, head).otherwise(shorter)


def _drop_first(elements: Column) -> Column:
    first, tail = F.element_at(elements, 1), F.slice(elements, F.lit(2), F.size(elements))
    shorter = F.concat(F.array(F.slice(first, F.lit(2), F.size(first))), tail)
    return F.when(F.size(first) == 1, tail).otherwise(shorter)


def _described(level: DataFrame) -> DataFrame:
    els = F.col("els")
    return level.select(
        "els",
        "id",
        _name(_drop_last(els)).alias("head"),
        _last(_last(els)).alias("z"),
        (F.size(_last(els)) > 1).alias("joined"),
    )


def _class_candidates(level: DataFrame, alive: int) -> DataFrame:
    """SPADE: (els, kind, l, r), siblings ``l`` and ``r`` joined inside the class of patterns that share all but the last item."""
    rows = _described(level)
    left = rows.select("head", F.col("id").alias("l"), F.col("els").alias("_l"), F.col("z").alias("lz"), F.col("joined").alias("lj"))
    right = rows.select("head", F.col("id").alias("r"), F.col("z").alias("x"), F.col("joined").alias("rj"))
    pairs = left.join(small_side(right, alive), "head")
    grown = lambda held, kind: held.select(_append(F.col("_l"), F.col("x"), kind).alias("els"), F.lit(kind).alias("kind"), "l", "r")
    return grown(pairs.where("NOT rj"), _NEW).unionByName(grown(pairs.where("x > lz AND lj = rj"), _SAME))


def _mapped_candidates(level: DataFrame, alive: int, pairs: DataFrame, n_pairs: int) -> DataFrame:
    """CM-SPADE: class candidates whose last two items form a frequent pair of the same kind."""
    last, before = _last(F.col("els")), F.get("els", F.size("els") - 2)
    second = F.when(F.col("kind") == _SAME, F.get(last, F.size(last) - 2)).otherwise(_last(before))
    keyed = _class_candidates(level, alive).withColumn("y", second).withColumn("z", _last(last))
    return keyed.join(small_side(pairs, n_pairs), ["kind", "y", "z"], "left_semi").select("els", "kind", "l", "r")


def _joined_candidates(level: DataFrame, alive: int, k: int) -> DataFrame:
    """GSP: join on (l without first item) = (r without last item), then prune by all drop-one-item patterns."""
    if k == 2:
        return _class_candidates(level, alive)
    els = F.col("els")
    left = level.select(els.alias("l"), _name(_drop_first(els)).alias("key"))
    right = level.select(_name(_drop_last(els)).alias("key"), _last(_last(els)).alias("x"), (F.size(_last(els)) > 1).alias("rj"))
    pairs = left.join(small_side(right, alive), "key")
    grown = (
        pairs.where("NOT rj").select(_append(F.col("l"), F.col("x"), _NEW).alias("els"))
        .unionByName(pairs.where("rj").select(_append(F.col("l"), F.col("x"), _SAME).alias("els")))
        .distinct()
    )
    shorter = grown.select(
        "els", F.posexplode("els").alias("at", "e")
    ).select("els", "at", "e", F.explode("e").alias("gone")).select(
        "els",
        _name(
            F.filter(
                F.transform("els", lambda e, i: F.when(i == F.col("at"), F.array_remove(e, F.col("gone"))).otherwise(e)),
                lambda e: F.size(e) > 0,
            )
        ).alias("p"),
    )
    known = level.select(_name(els).alias("p"))
    missing = shorter.join(small_side(known, alive), "p", "left_anti").select("els").distinct()
    return grown.join(missing, "els", "left_anti")


def cooccurrence(elements: DataFrame, min_support: float) -> DataFrame:
    """Frequent item pairs: kind ``s`` (first before second) and ``i`` (in one element)."""
    two = spade(elements, min_support, max_items=2).where("n_items = 2")
    return two.select(
        F.when(F.col("n_elements") == 2, _NEW).otherwise(_SAME).alias("kind"),
        F.get(F.flatten("elements"), F.lit(0)).alias("first_item"),
        F.get(F.flatten("elements"), F.lit(1)).alias("second_item"),
        "support_count",
    )


# -- earliest ends -------------------------------------------------------------------------------


def _candidates(grown: DataFrame, known: DataFrame, n_known: int) -> DataFrame:
    """Candidate sequences with the ids of their parts: ``q -> x``, or for one element ``grown`` plus item ``b``.

    A part that is not frequent has no id and the candidate drops out.
    """
    els = F.col("els")
    last = _last(els)
    named = grown.select(
        "els",
        _name(els).alias("name"),
        _name(F.slice(els, F.lit(1), F.size(els) - 1)).alias("q_name"),
        _name(F.array(last)).alias("x_name"),
        _name(F.array(F.slice(last, F.lit(1), F.size(last) - 1))).alias("grown_name"),
        _last(last).cast("int").alias("b"),
    )
    for part in ("q", "x", "grown"):
        ids = known.select(F.col("name").alias(f"{part}_name"), F.col("id").alias(part))
        named = named.join(small_side(ids, n_known), f"{part}_name", "left").drop(f"{part}_name")
    single = F.size("els") == 1
    return named.withColumn("single", single).where(
        (single & F.col("grown").isNotNull()) | (F.col("q").isNotNull() & F.col("x").isNotNull())
    )


def _grow(elements: DataFrame, min_support: float, max_items: int | None, max_elements: int | None) -> DataFrame:
    """GSP's levels. Packed sequences are counted row by row, longer ones by states and occurrences; the counts are added."""
    occurrences = states = ends = rows = pairs = None
    enc, idlists = _encode_idlists(elements, min_support)
    if enc.n_items and max_items != 1:
        packed, wide = _pack(idlists, enc.n_items)
        if packed is not None:
            rows = _first_rows(packed)
            pairs = _ends_and_items(_flat_states(rows))
        if wide is not None:
            longer = idlists if packed is None else idlists.join(wide, "sequence_id", "left_semi")
            occurrences = durable(_item_occurrences(_positions(longer)))
            states = durable(_first_states(occurrences))
            ends = durable(_last_ends(occurrences))
    level = enc.dictionary.select(F.array(F.array("id")).alias("els"), "support_count", "id")
    level = level.withColumn("name", F.col("id").cast("string"))
    found, known = level.select("els", "support_count"), level.select("name", "id")
    alive, n_known, k = enc.n_items, enc.n_items, 2
    while alive > 0 and (max_items is None or k <= max_items):
        grown = _joined_candidates(level, alive, k)
        if max_elements is not None:
            grown = grown.where(F.size("els") <= max_elements)
        candidates = durable(_candidates(grown, known, n_known))
        shape = candidates.agg(F.count(F.lit(1)).alias("n"), F.count_if("single").alias("n_single")).first()
        if shape["n"] == 0:
            break
        chains, sets = candidates.where("NOT single"), candidates.where("single")
        counted = _added(
            None if rows is None else _count_pairs(pairs, chains, shape["n"], ["q", "x"]),
            None if states is None else _count_after(states, ends, chains, shape["n"]),
        ).where(f"support_count >= {enc.threshold}")
        frequent = counted.join(small_side(chains, shape["n"]), ["q", "x"])
        columns = ["els", "name", "q", "x", "grown", "b", "single", "support_count"]
        level = frequent.select(*columns)
        grown_sets = None
        if shape["n_single"]:
            if states is not None:
                grown_sets = _intersect(occurrences, sets, shape["n_single"])
                if k != max_items:
                    grown_sets = durable(grown_sets)
            counted = _added(
                None if rows is None else _count_pairs(_items_together(rows), sets, shape["n_single"], ["grown", "b"]),
                None if states is None else _count_itemsets(grown_sets),
            ).where(f"support_count >= {enc.threshold}")
            level = level.unionByName(counted.join(small_side(sets, shape["n_single"]), ["grown", "b"]).select(*columns))
        level = durable(level)
        alive = level.count()
        found = found.unionByName(level.select("els", "support_count"))
        if k == max_items or alive == 0:  # no further level reads match states
            break
        level = _numbered(level, n_known)
        known, n_known = known.unionByName(level.select("name", "id")), n_known + alive
        if rows is not None:
            rows, flat = _advance_rows(rows, level, alive, bool(shape["n_single"]), k + 1 == max_items)
            pairs = _ends_and_items(flat)
        if states is not None:
            moved = _advance(states, occurrences, level.where("NOT single"), alive)
            if grown_sets is not None:
                kept = small_side(level.where("single").select("grown", "b", F.col("id").alias("x")), alive)
                fresh = durable(_spans(grown_sets.join(kept, ["grown", "b"])).select(*occurrences.columns))
                moved = moved.unionByName(_first_states(fresh))
                occurrences = occurrences.unionByName(fresh)
                ends = ends.unionByName(durable(_last_ends(fresh)))
            states = states.unionByName(durable(moved))
        k += 1
    return _decode(found, enc)


def _first_rows(packed: DataFrame) -> DataFrame:
    """``(sequence_id, items, states)``: the masks of the frequent itemsets of a packed sequence, and for each frequent
    pattern in it the positions ``after`` the earliest end of a match."""
    states = f"transform(items, i -> named_struct('p', i.x, 'after', {_AFTER.format('i.mask')}))"
    return packed.select("sequence_id", "items", F.expr(states).alias("states"))


def _flat_states(rows: DataFrame) -> DataFrame:
    each = rows.select("sequence_id", "items", F.explode("states").alias("s"))
    return each.select("sequence_id", "items", F.col("s.p").alias("q"), F.col("s.after").alias("after"))


def _ends_and_items(flat: DataFrame) -> DataFrame:
    """(sequence_id, items, q, x, mask): the positions of itemset x after the earliest end of pattern q, if there are any."""
    each = flat.withColumn("i", F.explode("items"))
    found = each.select("sequence_id", "items", "q", F.col("i.x").alias("x"), F.expr("i.mask & after").alias("mask"))
    return found.where("mask <> 0")


def _items_together(rows: DataFrame) -> DataFrame:
    """(sequence_id, grown, b, mask): the positions that two itemsets share, if there are any."""
    each = rows.select("sequence_id", "items", F.explode("items").alias("g")).withColumn("h", F.explode("items"))
    shared = each.select("sequence_id", F.col("g.x").alias("grown"), F.col("h.x").alias("b"), F.expr("g.mask & h.mask").alias("mask"))
    return shared.where("mask <> 0")


def _count_pairs(pairs: DataFrame, candidates: DataFrame, rows: int, by: list[str]) -> DataFrame:
    """Support of the candidates in packed sequences. A sequence has a pair of ids once at most."""
    met = pairs.select(*by).join(small_side(candidates.select(*by), rows), by, "left_semi")
    return met.groupBy(*by).agg(F.count(F.lit(1)).alias("support_count"))


def _advance_rows(rows: DataFrame, level: DataFrame, alive: int, with_sets: bool, last: bool) -> tuple[DataFrame, DataFrame]:
    """Packed sequences with the itemsets and patterns of ``level`` added, and their states, a row each.

    States that only the last level reads are counted as they are made and not laid out.
    """
    chains = small_side(level.where("NOT single").select("q", "x", "id"), alive)
    after = F.expr(_AFTER.format("mask")).alias("after")
    fresh = None
    if with_sets:
        sets = small_side(level.where("single").select("grown", "b", "id"), alive)
        fresh = _items_together(rows).join(sets, ["grown", "b"]).select("sequence_id", "id", "mask")
    if last:
        if fresh is not None:
            rows = durable(_with_more(rows, fresh, fresh.select("sequence_id", "id", after)))
        flat = _flat_states(rows)
        moved = _ends_and_items(flat).join(chains, ["q", "x"]).select("sequence_id", "items", F.col("id").alias("q"), after)
        return rows, flat.unionByName(moved)
    moved = _ends_and_items(_flat_states(rows)).join(chains, ["q", "x"]).select("sequence_id", "id", after)
    if fresh is not None:
        moved = moved.unionByName(fresh.select("sequence_id", "id", after))
    rows = durable(_with_more(rows, fresh, moved))
    return rows, _flat_states(rows)


def _with_more(rows: DataFrame, items: DataFrame | None, states: DataFrame) -> DataFrame:
    """``rows`` with more ``items`` (sequence_id, id, mask) and ``states`` (sequence_id, id, after)."""
    added = [("states", states, F.struct(F.col("id").alias("p"), "after"))]
    if items is not None:
        added.append(("items", items, F.struct(F.col("id").alias("x"), "mask")))
    for name, more, value in added:
        held = more.groupBy(F.col("sequence_id").alias("_of")).agg(F.collect_list(value).alias("_more"))
        rows = rows.join(held, F.col("sequence_id") == F.col("_of"), "left").withColumn(
            name, F.when(F.col("_more").isNull(), F.col(name)).otherwise(F.concat(name, "_more"))
        ).drop("_of", "_more")
    return rows


def _decode(found: DataFrame, enc: EncodedSequences) -> DataFrame:
    """Id patterns to the canonical pattern table."""
    parts = (
        found.withColumn("p", _name(F.col("els")))
        .select("p", "support_count", F.posexplode("els").alias("at", "e"))
        .select("p", "support_count", "at", F.explode("e").alias("id"))
        .join(small_side(enc.dictionary.select("id", "item"), enc.n_items), "id")
        .groupBy("p", "support_count")
        .agg(F.sort_array(F.collect_list(F.struct("at", "item"))).alias("flat"))
    )
    at = F.array_distinct(F.transform("flat", lambda s: s["at"]))
    elements = F.transform(
        at, lambda a: F.transform(F.filter("flat", lambda s: s["at"] == a), lambda s: s["item"])
    )
    return parts.select(elements.alias("elements"), F.size("flat").alias("n_items"), "support_count").select(
        "elements",
        F.size("elements").alias("n_elements"),
        "n_items",
        "support_count",
        (F.col("support_count") / F.lit(float(max(enc.n, 1)))).alias("support"),
    )


def gsp(elements: DataFrame, min_support: float = 0.1, max_items: int | None = None, max_elements: int | None = None) -> DataFrame:
    """Level-wise: join, prune, count at the earliest match ends of the prefixes."""
    return _grow(elements, min_support, max_items, max_elements)


# -- packed sequences -----------------------------------------------------------------------------

# The positions after the first one of a mask; the top bit alone has none, and taking one from it is null, not an error.
_AFTER = "coalesce(~({0} ^ try_subtract({0}, 1L)), 0L)"


def _pack(idlists: DataFrame, n_items: int) -> tuple[DataFrame | None, DataFrame | None]:
    """``(sequence_id, items array<(x, mask)>)`` of the sequences that lie in block 0, and the ids of all other sequences.

    Either is None if it has no rows.
    """
    if n_items > PACKED_ITEMS:
        return None, idlists.select("sequence_id").distinct()
    wide = durable(idlists.where("block <> 0").select("sequence_id").distinct())
    n_wide = wide.count()
    narrow = idlists.where("block = 0 AND sequence_id IS NOT NULL")
    if n_wide:
        narrow = narrow.join(small_side(wide, n_wide), "sequence_id", "left_anti")
    # a fixed number of parts: the rows are few and short for the work that they make
    parts = max(int(idlists.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    item = F.struct(F.col("p").cast("int").alias("x"), "mask")
    packed = durable(narrow.repartition(parts, "sequence_id").groupBy("sequence_id").agg(F.collect_list(item).alias("items")))
    return (None if packed.isEmpty() else packed), (wide if n_wide else None)


def _added(*counts: DataFrame | None) -> DataFrame:
    """Support counts of disjoint sets of sequences, added by their other columns."""
    parts = [c for c in counts if c is not None]
    if len(parts) == 1:
        return parts[0]
    keys = [c for c in parts[0].columns if c != "support_count"]
    return parts[0].unionByName(parts[1]).groupBy(*keys).agg(F.sum("support_count").alias("support_count"))


def _by_kind(counted: DataFrame) -> DataFrame:
    """Columns ``new`` and ``same`` to a row per kind."""
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("support_count")) for kind, c in ((_NEW, "new"), (_SAME, "same"))])
    keys = [c for c in counted.columns if c not in ("new", "same")]
    return counted.select(*keys, F.inline(kinds)).where("support_count > 0")


def _by_pattern(level: DataFrame, pattern: str, alive: int, n_items: int) -> DataFrame:
    """``(pattern, news, sames)``: the ids of what a pattern grows to, at the place of the item that it grows by."""
    z = _last(_last(F.col("els")))
    entry = F.struct(F.when(F.col("kind") == _SAME, -z).otherwise(z).alias("key"), "id")
    held = level.groupBy(pattern).agg(F.map_from_entries(F.collect_list(entry)).alias("_grown"))
    ids = "transform(sequence(0, {}), i -> _grown[{}i])"
    return small_side(held.select(pattern, F.expr(ids.format(n_items, "")).alias("news"), F.expr(ids.format(n_items, "-")).alias("sames")), alive)


def _first_classes(packed: DataFrame) -> DataFrame:
    members = "transform(items, i -> named_struct('p', cast(i.x AS bigint), 'z', i.x, 'joined', false, 'mask', i.mask))"
    return packed.select("sequence_id", F.expr(members).alias("members"))


def _each_member(classes: DataFrame) -> DataFrame:
    each = classes.select("sequence_id", "members", F.explode("members").alias("m"))
    return each.select(
        "sequence_id", "members", F.col("m.p").alias("l"), F.col("m.z").alias("z"), F.col("m.joined").alias("joined"),
        F.col("m.mask").alias("mask"), F.expr(_AFTER.format("m.mask")).alias("after"),
    )


def _count_classes(classes: DataFrame, candidates: DataFrame | None, rows: int) -> DataFrame:
    """(l, r, kind, support_count) of the siblings that meet in a sequence; of ``candidates`` only, if not all siblings are."""
    later, beside = "NOT o.joined AND (o.mask & after) <> 0", "o.z > z AND o.joined = joined AND (o.mask & mask) <> 0"
    pairs = _each_member(classes).withColumn("o", F.explode("members")).withColumn("r", F.col("o.p"))
    if candidates is not None:
        tried = candidates.groupBy("l", "r").agg(F.bool_or(F.col("kind") == _NEW).alias("_new"), F.bool_or(F.col("kind") == _SAME).alias("_same"))
        pairs = pairs.join(small_side(tried, rows), ["l", "r"])
        later, beside = f"_new AND {later}", f"_same AND {beside}"
    met = pairs.select("l", "r", F.expr(later).alias("_later"), F.expr(beside).alias("_beside")).where("_later OR _beside")
    return _by_kind(met.groupBy("l", "r").agg(F.count_if("_later").alias("new"), F.count_if("_beside").alias("same")))


def _grow_classes(classes: DataFrame, level: DataFrame, alive: int, n_items: int) -> DataFrame:
    """The classes of the next level: a row per sequence and frequent pattern ``l``, with what l grows to."""
    each = _each_member(classes).join(_by_pattern(level, "l", alive, n_items), "l")
    members = """concat(
        transform(filter(members, r -> NOT r.joined AND (r.mask & after) <> 0 AND get(news, r.z) IS NOT NULL),
            r -> named_struct('p', get(news, r.z), 'z', r.z, 'joined', false, 'mask', r.mask & after)),
        transform(filter(members, r -> r.z > z AND r.joined = joined AND (r.mask & mask) <> 0 AND get(sames, r.z) IS NOT NULL),
            r -> named_struct('p', get(sames, r.z), 'z', r.z, 'joined', true, 'mask', r.mask & mask)))"""
    return each.select("sequence_id", F.expr(members).alias("members"))


def _count_last(
    classes: DataFrame, level: DataFrame, alive: int, n_items: int, candidates: DataFrame | None, rows: int
) -> DataFrame:
    """:func:`_count_classes` of what ``classes`` grow to by ``level``. The grown classes are read by nothing else, so they are not laid out.

    The members m of a grown class are made of a member i of the class before, the siblings of m of the members j.
    """
    made = """array(
        IF(NOT i.joined AND (i.mask & after) <> 0, named_struct('p', get(news, i.z), 'z', i.z, 'joined', false, 'mask', i.mask & after), NULL),
        IF(i.z > z AND i.joined = joined AND (i.mask & mask) <> 0, named_struct('p', get(sames, i.z), 'z', i.z, 'joined', true, 'mask', i.mask & mask), NULL))"""
    each = _each_member(classes).join(_by_pattern(level, "l", alive, n_items), "l").withColumn("i", F.explode("members"))
    kept = ["members", "z", "joined", "mask", "after", "news", "sames"]
    grown = each.select(*kept, F.explode(F.expr(made)).alias("m")).where("m.p IS NOT NULL")
    pairs = grown.select(*kept, "m", F.expr(_AFTER.format("m.mask")).alias("m_after")).withColumn("j", F.explode("members"))
    new_j, same_j = "(j.mask & after)", "(j.mask & mask)"
    sides = f"""array(
        IF(NOT j.joined AND ({new_j} & m_after) <> 0, named_struct('r', get(news, j.z), 'kind', '{_NEW}'), NULL),
        IF(j.z > m.z AND NOT m.joined AND NOT j.joined AND ({new_j} & m.mask) <> 0, named_struct('r', get(news, j.z), 'kind', '{_SAME}'), NULL),
        IF(j.z > m.z AND m.joined AND j.z > z AND j.joined = joined AND ({same_j} & m.mask) <> 0, named_struct('r', get(sames, j.z), 'kind', '{_SAME}'), NULL))"""
    met = pairs.select(F.col("m.p").alias("l"), F.explode(F.expr(sides)).alias("o")).select("l", "o.r", "o.kind").where("r IS NOT NULL")
    if candidates is not None:
        met = met.join(small_side(candidates.select("l", "r", "kind"), rows), ["l", "r", "kind"], "left_semi")
    return met.groupBy("l", "r", "kind").agg(F.count(F.lit(1)).alias("support_count"))


# -- id-lists -------------------------------------------------------------------------------------


def _encode_idlists(elements: DataFrame, min_support: float) -> tuple[EncodedSequences, DataFrame]:
    """:func:`encode` and ``(p, sequence_id, block, mask)``, both from one pass over the elements.

    A mask holds the positions of a frequent item, a bit per position of a block of 64.
    """
    require_columns(elements, "sequence_id", "position", "items")
    # a sequence without items stays as a row without a slot, so that it is counted
    rows = elements.select("sequence_id", "position", F.posexplode_outer("items").alias("slot", "item"))
    bit = F.expr("shiftleft(1L, cast(position & 63 AS int))")
    keys = ["sequence_id", "item", F.col("slot").isNotNull().alias("held"), F.expr("shiftright(position, 6)").alias("block")]
    lists = durable(rows.groupBy(*keys).agg(F.bit_or(bit).alias("mask")))
    longer = F.bool_or(F.expr("block IS NULL OR block <> 0"))
    figures = lists.groupBy("sequence_id").agg(longer.alias("longer")).agg(F.count(F.lit(1)).alias("n"), F.count_if("longer").alias("n_longer")).first()
    n, lists = figures["n"], lists.where("held")
    threshold = min_count(min_support, n)
    # in one block, an item of a sequence has one row
    once = lists.select("sequence_id", "item")
    dictionary = _dictionary(once.distinct() if figures["n_longer"] else once, threshold)
    enc = EncodedSequences(n, threshold, dictionary, dictionary.count(), elements)
    items = small_side(dictionary.select("item", F.col("id").cast("long").alias("p")), enc.n_items)
    return enc, lists.join(items, "item").select("p", "sequence_id", "block", "mask")


def _positions(idlists: DataFrame) -> DataFrame:
    """``(sequence_id, position, x)``: id-lists of items, a row per position."""
    each = idlists.select("sequence_id", F.col("p").cast("int").alias("x"), "block", "mask", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("at"))
    return each.where("shiftright(mask, at) & 1L <> 0").select("sequence_id", F.expr("block * 64L + at").alias("position"), "x")


def _bounds(idlists: DataFrame) -> DataFrame:
    """``(p, sequence_id, f, last)``: the first and last position of each id-list. Taking one from the top bit alone is null, not an error."""
    lowest = F.expr("block * 64L + coalesce(bit_count(~mask & try_subtract(mask, 1L)), 63)")
    highest = F.expr("block * 64L + length(bin(mask)) - 1")
    return idlists.groupBy("p", "sequence_id").agg(F.min(lowest).alias("f"), F.max(highest).alias("last"))


def _count_later(bounds: DataFrame, chains: DataFrame, rows: int) -> DataFrame:
    """Support of l, then the last item of r: some position of r's id-list lies after the first one of l's."""
    left = bounds.select(F.col("p").alias("l"), "sequence_id", "f").join(small_side(chains.select("l", "r"), rows), "l")
    met = left.join(bounds.select(F.col("p").alias("r"), "sequence_id", "last"), ["sequence_id", "r"]).where("last > f")
    return met.groupBy("l", "r").agg(F.count(F.lit(1)).alias("support_count"))


def _meet(idlists: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
    """The id-lists of siblings of one element joined: AND of their masks."""
    left = idlists.withColumnRenamed("p", "l").join(small_side(sets.select("l", "r"), rows), "l")
    right = idlists.select(F.col("p").alias("r"), "sequence_id", "block", F.col("mask").alias("_other"))
    both = left.join(right, ["sequence_id", "r", "block"]).withColumn("mask", F.col("mask").bitwiseAND(F.col("_other")))
    return both.where("mask <> 0").select("l", "r", "sequence_id", "block", "mask")


def _later(bounds: DataFrame, idlists: DataFrame, level: DataFrame, rows: int) -> DataFrame:
    """Id-lists of ``id`` = l, then the last item of r: r's, without the positions up to the first one of l's."""
    grown = small_side(level.select("id", F.col("l").alias("p"), "r"), rows)
    left = bounds.select("p", "sequence_id", "f").join(grown, "p").select("id", F.col("r").alias("p"), "sequence_id", "f")
    rest = F.expr("CASE WHEN block > shiftright(f, 6) THEN mask ELSE mask & shiftleft(-2L, cast(f & 63 AS int)) END")
    held = left.join(idlists, ["p", "sequence_id"]).where("block >= shiftright(f, 6)").withColumn("mask", rest)
    return held.where("mask <> 0").select(F.col("id").alias("p"), "sequence_id", "block", "mask")


def _vertical(elements: DataFrame, min_support: float, mapped: bool, max_items: int | None, max_elements: int | None) -> DataFrame:
    """SPADE's levels. The id-list of a pattern holds the positions at which its matches end.

    A pattern is made of two siblings, so a level reads the id-lists of the
    level before and nothing else. Counting a chain needs their bounds only,
    one row per pattern and sequence; id-lists are made for frequent patterns.
    In packed sequences the id-lists of a class of siblings are one row.
    """
    enc, idlists = _encode_idlists(elements, min_support)
    found = enc.dictionary.select(F.array(F.array("id")).alias("els"), "support_count")
    if not enc.n_items or max_items == 1:
        return _decode(found, enc)
    packed, wide = _pack(idlists, enc.n_items)
    classes = None if packed is None else _first_classes(packed)
    if packed is None:
        idlists = durable(idlists)
    else:
        idlists = None if wide is None else durable(idlists.join(wide, "sequence_id", "left_semi"))
    last_grown = None
    level = enc.dictionary.select(F.array(F.array("id")).alias("els"), F.col("id").cast("long").alias("id"))
    alive, k, pair_map, n_pairs = enc.n_items, 2, None, 0
    while alive and (max_items is None or k <= max_items):
        grown = _class_candidates(level, alive) if pair_map is None else _mapped_candidates(level, alive, pair_map, n_pairs)
        if max_elements is not None:
            grown = grown.where(F.size("els") <= max_elements)
        candidates = durable(grown)
        shape = candidates.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == _SAME).alias("n_same")).first()
        if shape["n"] == 0:
            break
        counted = met = bounds = in_classes = None
        if classes is not None:
            some = pair_map is not None or max_elements is not None
            tried = candidates if some else None
            if last_grown is None:
                in_classes = _count_classes(classes, tried, shape["n"])
            else:
                in_classes = _count_last(classes, *last_grown, enc.n_items, tried, shape["n"])
        if idlists is not None:
            bounds = durable(_bounds(idlists))
            counted = _count_later(bounds, candidates.where(F.col("kind") == _NEW), shape["n"]).withColumn("kind", F.lit(_NEW))
            if shape["n_same"]:
                met = _meet(idlists, candidates.where(F.col("kind") == _SAME), shape["n_same"])
                if k != max_items:
                    met = durable(met)
                once = met.select("l", "r", "sequence_id").distinct().groupBy("l", "r").agg(F.count(F.lit(1)).alias("support_count"))
                counted = counted.unionByName(once.withColumn("kind", F.lit(_SAME)))
        counted = _added(in_classes, counted).where(f"support_count >= {enc.threshold}")
        level = counted.join(small_side(candidates, shape["n"]), ["l", "r", "kind"])
        level = durable(level.withColumn("id", F.monotonically_increasing_id()))
        alive = level.count()
        found = found.unionByName(level.select("els", "support_count"))
        if k == max_items or alive == 0:
            break
        if k == 2 and mapped:
            flat = F.flatten("els")
            pair_map, n_pairs = level.select("kind", F.get(flat, F.lit(0)).alias("y"), F.get(flat, F.lit(1)).alias("z")), alive
        if classes is not None and k + 1 == max_items:
            last_grown = level, alive
        elif classes is not None:
            classes = durable(_grow_classes(classes, level, alive, enc.n_items))
        if idlists is not None:
            moved = _later(bounds, idlists, level.where(F.col("kind") == _NEW), alive)
            if met is not None:
                kept = small_side(level.where(F.col("kind") == _SAME).select("l", "r", F.col("id").alias("p")), alive)
                moved = moved.unionByName(met.join(kept, ["l", "r"]).select("p", "sequence_id", "block", "mask"))
            idlists = durable(moved)
        k += 1
    return _decode(found, enc)


def spade(elements: DataFrame, min_support: float = 0.1, max_items: int | None = None, max_elements: int | None = None) -> DataFrame:
    """Vertical: join the id-lists of siblings inside prefix classes."""
    return _vertical(elements, min_support, False, max_items, max_elements)


def cm_spade(elements: DataFrame, min_support: float = 0.1, max_items: int | None = None, max_elements: int | None = None) -> DataFrame:
    """SPADE with co-occurrence pruning."""
    return _vertical(elements, min_support, True, max_items, max_elements)


# -- projections ----------------------------------------------------------------------------------


def prefixspan(elements: DataFrame, min_support: float = 0.1, max_items: int | None = None, max_elements: int | None = None) -> DataFrame:
    """Prefix growth on projected databases kept as rows.

    The projection of a prefix on a sequence is its pointer, the position ``f``
    at which the earliest match ends. What follows is counted for all prefixes
    of a length at once and without candidates: an item opens a new element if
    its last occurrence lies after ``f``, and joins the last element if an
    element after the rest of the prefix holds that element and the item. Only
    what is found frequent is projected further, by one look into the chunk of
    positions that holds the next occurrence. No sequence is laid out whole.
    """
    enc, idlists = _encode_idlists(elements, min_support)
    found = enc.dictionary.select(F.array(F.array("id")).alias("els"), "support_count")
    if not enc.n_items or max_items == 1:
        return _decode(found, enc)
    packed, wide = _pack(idlists, enc.n_items)
    db = None
    if wide is not None:
        db = _Projected(_positions(idlists if packed is None else idlists.join(wide, "sequence_id", "left_semi")))
    level = enc.dictionary.select(F.array(F.array("id")).alias("els"), F.col("id").cast("long").alias("id"))
    k, alive = 2, enc.n_items
    rows = None if packed is None else _each_projection(_first_projections(packed))
    states, open_rows = (None, None) if db is None else (db.first_states, db.first_open)
    while alive and (max_items is None or k <= max_items):
        last = k == max_items
        in_rows = longer = joined = None
        if rows is not None:
            in_rows = _count_following(rows, level, alive, max_elements)
        if db is not None:
            longer = db.new_elements(states, level, alive, max_elements).withColumn("kind", F.lit(_NEW))
            joined = db.same_element(open_rows)
            if joined is not None:
                joined = joined if last else durable(joined)
                once = joined.select("p", "x", "sequence_id").distinct().groupBy("p", "x").agg(F.count(F.lit(1)).alias("support_count"))
                longer = longer.unionByName(once.withColumn("kind", F.lit(_SAME)))
        grown = _added(in_rows, longer).where(f"support_count >= {enc.threshold}")
        level = _next_level(grown, level, alive)
        found, alive = found.unionByName(level.select("els", "support_count")), level.count()
        if alive and not last:
            if rows is not None and k + 1 == max_items:
                rows = _project_last(rows, level, alive, enc.n_items)
            elif rows is not None:
                rows = _each_projection(durable(_project_rows(rows, level, alive, enc.n_items)))
            if db is not None:
                states, open_rows = db.project(states, open_rows, joined, level, alive)
        k += 1
    return _decode(found, enc)


def _next_level(grown: DataFrame, level: DataFrame, alive: int) -> DataFrame:
    """The next level: els, id, support_count, the prefix p, the item x and the kind of its growth."""
    named = grown.join(small_side(level.select(F.col("id").alias("p"), F.col("els").alias("head")), alive), "p")
    els = F.when(F.col("kind") == _NEW, _append(F.col("head"), F.col("x"), _NEW)).otherwise(_append(F.col("head"), F.col("x"), _SAME))
    return durable(named.select(els.alias("els"), "support_count", "p", "x", "kind", F.monotonically_increasing_id().alias("id")))


def _first_projections(packed: DataFrame) -> DataFrame:
    states = "transform(items, i -> named_struct('p', cast(i.x AS bigint), 'z', i.x, 'open', i.mask))"
    return packed.select("sequence_id", "items", F.expr(states).alias("states"))


def _each_projection(rows: DataFrame) -> DataFrame:
    """The projections of packed sequences: prefix ``p`` ends with item ``z`` at the positions ``open``, first before those ``after``."""
    return _state_columns(rows.select("sequence_id", "items", F.explode("states").alias("s")))


def _state_columns(each: DataFrame) -> DataFrame:
    return each.select(
        "sequence_id", "items", F.col("s.p").alias("p"), F.col("s.z").alias("z"), F.col("s.open").alias("open"),
        F.expr(_AFTER.format("s.open")).alias("after"),
    )


def _count_following(rows: DataFrame, level: DataFrame, alive: int, max_elements: int | None) -> DataFrame:
    """(p, x, kind, support_count) of the items of a packed sequence that follow a prefix or stand with its last element."""
    each, later, beside = rows, "(i.mask & after) <> 0", "i.x > z AND (i.mask & open) <> 0"
    if max_elements is not None:
        shorter = level.select(F.col("id").alias("p"), (F.size("els") < max_elements).alias("able"))
        each, later = each.join(small_side(shorter, alive), "p"), f"able AND {later}"
    pairs = each.withColumn("i", F.explode("items")).select("p", F.col("i.x").alias("x"), F.expr(later).alias("_later"), F.expr(beside).alias("_beside"))
    met = pairs.where("_later OR _beside").groupBy("p", "x")
    return _by_kind(met.agg(F.count_if("_later").alias("new"), F.count_if("_beside").alias("same")))


def _project_rows(rows: DataFrame, level: DataFrame, alive: int, n_items: int) -> DataFrame:
    """Packed sequences projected on the patterns of ``level``: a row per sequence and prefix, with the states of what it grows to."""
    each = rows.join(_by_pattern(level, "p", alive, n_items), "p")
    states = """concat(
        transform(filter(items, i -> (i.mask & after) <> 0 AND get(news, i.x) IS NOT NULL),
            i -> named_struct('p', get(news, i.x), 'z', i.x, 'open', i.mask & after)),
        transform(filter(items, i -> i.x > z AND (i.mask & open) <> 0 AND get(sames, i.x) IS NOT NULL),
            i -> named_struct('p', get(sames, i.x), 'z', i.x, 'open', i.mask & open)))"""
    return each.select("sequence_id", "items", F.expr(states).alias("states"))


def _project_last(rows: DataFrame, level: DataFrame, alive: int, n_items: int) -> DataFrame:
    """The projections of :func:`_project_rows`, a row each. They are read once, for counting, so they are not laid out by prefix."""
    each = rows.join(_by_pattern(level, "p", alive, n_items), "p").withColumn("i", F.explode("items"))
    states = """array(
        IF((i.mask & after) <> 0, named_struct('p', get(news, i.x), 'z', i.x, 'open', i.mask & after), NULL),
        IF(i.x > z AND (i.mask & open) <> 0, named_struct('p', get(sames, i.x), 'z', i.x, 'open', i.mask & open), NULL))"""
    grown = each.select("sequence_id", "items", F.explode(F.expr(states)).alias("s")).where("s.p IS NOT NULL")
    return _state_columns(grown)


class _Projected:
    """The rows that projections point into.

    * ``ends``: the last position of each item in each sequence;
    * ``chunks``: positions of an item in a sequence, CHUNK positions a row, with the last position before the row;
    * ``sets``: the elements with more than one frequent item, as sorted item ids.

    Pointers are (p, sequence_id, f). ``open`` rows (p, sequence_id, position, z) are the elements of ``sets`` that end a match of p
    with item z last and hold greater items; they are None if there are no such elements at all.
    """

    def __init__(self, positions: DataFrame):
        coded = durable(positions)
        chunked = coded.groupBy("sequence_id", "x", F.expr(f"position div {CHUNK}").alias("chunk")).agg(
            F.sort_array(F.collect_list("position")).alias("positions")
        )
        self.chunks = durable(_spans(chunked).drop("chunk"))
        spans = self.chunks.groupBy("sequence_id", "x").agg(F.max("last").alias("last"), F.min(F.element_at("positions", 1)).alias("f"))
        self.ends = durable(spans)
        self.first_states = self.ends.select(F.col("x").cast("long").alias("p"), "sequence_id", "f")
        sets = coded.groupBy("sequence_id", "position").agg(F.sort_array(F.collect_list("x")).alias("ids")).where(F.size("ids") > 1)
        self.sets = durable(sets)
        self.first_open = None
        if self.sets.limit(1).count():
            each = self.sets.select("sequence_id", "position", "ids", F.explode("ids").alias("z")).where(F.col("z") < F.array_max("ids"))
            self.openers = durable(each.select("sequence_id", "position", "z"))
            self.first_open = self.openers.withColumn("p", F.col("z").cast("long"))

    def new_elements(self, states: DataFrame, level: DataFrame, alive: int, max_elements: int | None) -> DataFrame:
        """(p, x, support_count) of the items that follow a prefix."""
        if max_elements is not None:
            able = level.where(F.size("els") < max_elements).select(F.col("id").alias("p"))
            states = states.join(small_side(able, alive), "p", "left_semi")
        after = states.join(self.ends.select("sequence_id", "x", "last"), "sequence_id").where("last > f")
        return after.groupBy("p", "x").agg(F.count(F.lit(1)).alias("support_count"))

    def same_element(self, open_rows: DataFrame | None) -> DataFrame | None:
        """(p, x, sequence_id, position) of the items that stand with the last element of a prefix."""
        if open_rows is None:
            return None
        beside = open_rows.join(self.sets, ["sequence_id", "position"])
        return beside.select("p", F.explode(F.filter("ids", lambda i: i > F.col("z"))).alias("x"), "sequence_id", "position")

    def project(
        self, states: DataFrame, open_rows: DataFrame | None, joined: DataFrame | None, level: DataFrame, alive: int
    ) -> tuple[DataFrame, DataFrame | None]:
        """Pointers and open rows of the patterns of ``level``."""
        grown = lambda kind: small_side(level.where(F.col("kind") == kind).select("p", "x", "id"), alive)
        moved = _step(states.join(grown(_NEW), "p").drop("p"), self.chunks).select(F.col("id").alias("p"), "sequence_id", "x", "f")
        if joined is None:
            return durable(moved.select("p", "sequence_id", "f")), None
        moved = durable(moved)
        stay = joined.join(grown(_SAME), ["p", "x"]).select(F.col("id").alias("p"), "sequence_id", "position", F.col("x").alias("z"))
        stay = durable(stay)
        first = stay.groupBy("p", "sequence_id").agg(F.min("position").alias("f"))
        states = durable(moved.select("p", "sequence_id", "f").unionByName(first))
        fresh = moved.withColumnRenamed("x", "z").join(self.openers, ["sequence_id", "z"]).where("position >= f")
        more = stay.join(self.openers, ["sequence_id", "position", "z"])
        columns = ["p", "sequence_id", "position", "z"]
        return states, durable(fresh.select(*columns).unionByName(more.select(*columns)))


ALGORITHMS = {"prefixspan": prefixspan, "gsp": gsp, "spade": spade, "cm_spade": cm_spade}


# -- matching given patterns ----------------------------------------------------------------------


def match_patterns(elements: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(pattern, sequence_id)`` for every given pattern a sequence contains.

    ``patterns`` has a key ``pattern`` and nested ``elements``. Works element
    by element on match states, so neither the sequences nor the pattern x
    sequence product is ever laid out. Every sequence holds the empty pattern.
    """
    named = durable(patterns.select("pattern", "elements").distinct())
    out = _matches(elements, named.where(F.size("elements") > 0), ["pattern", "sequence_id"])
    for row in named.where(F.size("elements") == 0).select("pattern").collect():
        out = out.unionByName(elements.select(F.lit(row["pattern"]).alias("pattern"), "sequence_id").distinct())
    return out


def matching_sequences(elements: DataFrame, patterns: DataFrame) -> DataFrame:
    """``sequence_id`` of the sequences that contain at least one of ``patterns`` (pattern, elements), once each.

    A sequence leaves with all its match states as soon as a pattern is
    complete in it, shorter patterns before longer ones, so no (pattern,
    sequence) pairs are put out. Every sequence holds the empty pattern.
    """
    named = durable(patterns.select("pattern", "elements").distinct())
    if not named.where(F.size("elements") == 0).isEmpty():
        return elements.select("sequence_id").distinct()
    return _matches(elements, named, ["sequence_id"])


def _matches(elements: DataFrame, given: DataFrame, wanted: list[str]) -> DataFrame:
    """Rows of ``wanted`` for the non-empty patterns complete in a sequence; of ``sequence_id`` alone, one row and no further steps."""
    figures = given.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("elements")).alias("longest")).first()
    n, longest = figures["n"], figures["longest"] or 0
    key = lambda e: F.array_join(F.sort_array(e), "\u0001")
    steps = given.select("pattern", F.size("elements").alias("length"), F.posexplode("elements").alias("at", "e"))
    steps = steps.select("pattern", "length", "at", key(F.col("e")).alias("x"), F.sort_array("e").alias("e"))
    sets = steps.select(F.col("e").alias("items")).distinct()
    rarest = with_rarest_item(sets, explode_items(elements)).select(
        key(F.col("items")).alias("x"), F.col("items").alias("e"), "item"
    )
    # occurrences of each wanted itemset, found through its rarest item
    anchored = elements.select("sequence_id", "position", "items", F.explode("items").alias("item"))
    hits = anchored.join(small_side(rarest, n * max(longest, 1)), "item").where(F.size(F.array_except("e", "items")) == 0)
    out = None
    if "pattern" in wanted and 0 < longest <= PACKED_STEPS:
        names = dense_index(steps.where("x IS NOT NULL").select("x").distinct(), "x", "p")
        names = durable(names)
        n_sets = names.count()
        bit = F.expr("shiftleft(1L, cast(position & 63 AS int))")
        masks = hits.join(small_side(names, n_sets), "x").groupBy("p", "sequence_id", F.expr("shiftright(position, 6)").alias("block"))
        packed, wide = _pack(durable(masks.agg(F.bit_or(bit).alias("mask"))), n_sets)
        if packed is not None:
            coded = durable(steps.join(small_side(names, n_sets), "x").select("pattern", "length", "at", F.col("p").cast("int").alias("x")))
            out = _match_packed(packed, coded, n, longest).select(*wanted)
            if wide is None:
                return out
            hits = hits.join(wide, "sequence_id", "left_semi")
    occurrences = durable(
        _spans(
            hits.groupBy("x", "sequence_id", F.expr(f"position div {CHUNK}").alias("chunk")).agg(
                F.sort_array(F.collect_set("position")).alias("positions")
            )
        )
    )
    at = lambda i: small_side(steps.where(F.col("at") == i).select("pattern", "length", "x"), n)
    first = occurrences.where("before IS NULL").withColumn("f", F.element_at("positions", 1))
    states = durable(first.join(at(0), "x").select("pattern", "length", "sequence_id", "f"))
    out = states.where("false").select(*wanted) if out is None else out
    for i in range(1, longest + 1):
        complete, rest = states.where(F.col("length") == i).select(*wanted), states.where(F.col("length") > i)
        if wanted == ["sequence_id"]:
            complete = durable(complete.distinct())
            rest = rest.join(complete, "sequence_id", "left_anti")
        out = out.unionByName(complete)
        if i < longest:
            states = durable(_step(rest.drop("length").join(at(i), "pattern"), occurrences).select("pattern", "length", "sequence_id", "f"))
    return out


def _match_packed(packed: DataFrame, steps: DataFrame, n: int, longest: int) -> DataFrame:
    """``(pattern, sequence_id)`` of packed sequences, which hold masks of the wanted itemsets: element by element, with no join of rows."""
    at = lambda i: small_side(steps.where(F.col("at") == i).select("pattern", "length", "x"), n)
    first = packed.select("sequence_id", "items", F.explode("items").alias("o")).withColumn("x", F.col("o.x"))
    kept = ["pattern", "length", "sequence_id", "items"]
    states = first.join(at(0), "x").select(*kept, F.expr(_AFTER.format("o.mask")).alias("after"))
    out = None
    for i in range(1, longest + 1):
        complete = states.where(F.col("length") == i).select("pattern", "sequence_id")
        out = complete if out is None else out.unionByName(complete)
        if i < longest:
            rest = states.where(F.col("length") > i).drop("length").join(at(i), "pattern").withColumn("o", F.explode("items"))
            rest = rest.where("o.x = x AND (o.mask & after) <> 0")
            states = rest.select(*kept, F.expr(_AFTER.format("(o.mask & after)")).alias("after"))
    return out


def count_patterns(elements: DataFrame, patterns: DataFrame) -> DataFrame:
    """Support count of each given pattern, 0 included."""
    counts = match_patterns(elements, patterns).groupBy("pattern").agg(F.count(F.lit(1)).alias("_n"))
    return (
        patterns.select("pattern", "elements")
        .join(counts, "pattern", "left")
        .select("pattern", "elements", F.coalesce("_n", F.lit(0)).alias("support_count"))
    )
