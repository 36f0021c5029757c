"""Near-duplicate detection: SetSketch registers banded, compared by likelihood, then verified on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UID, as_scan, chunks, keyed_texts, mix64, span_hashes, stored, utf8_batch, without
from .substring_dedup import words_of
from .windows import gram_hashes

# SetSketch: registers are 1 - log_BASE of the least of exponential variables of rate RATE, cut to 0 .. LIMIT.
BASE, RATE, LIMIT = 1.001, 20.0, 65_535
# Two sets of similarity J share a band of ROWS registers with probability J**ROWS or a little more. With 24 bands
# of 4, pairs of similarity 0.85 are missed with probability 2e-8, of 0.8 with 3e-6.
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
# A pair is dropped before verification if a similarity at the threshold is e**16 times less likely than the best one.
LESS_LIKELY = 16.0
# Members of a group that are compared with the others of it in one round.
PIVOTS = 64
# The first round, which links most of what is linked, looks at so many bands only; the others at all of them.
FIRST_BANDS = 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = mix64(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64)).reshape(2, REGISTERS)
_FACTORS, _SHIFTS = _SEEDS[0] | np.uint64(1), _SEEDS[1]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of n words per text; of all its words if it has fewer."""
    lower = _LOWER[data]
    begin, end, at = words_of(lower, offsets)
    words = span_hashes(lower, begin, end)
    grams = gram_hashes(words, n) if len(words) >= n else words[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(gram_hashes(words[a:b], b - a) + np.uint64(b - a))
        else:
            out.append(words[:0])
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of non-empty sets, a row each. The registers of a union are the maxima of those of its parts."""
    joined = np.concatenate(sets)
    starts = np.append(0, np.cumsum([len(s) for s in sets[:-1]])).astype(np.int64)
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(joined * _FACTORS[i] + _SHIFTS[i], starts)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    with np.errstate(divide="ignore"):
        exponential = -np.log1p(-np.minimum(uniform, 1 - 2**-53)) / RATE
        return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def unlikely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of register rows speak clearly against a similarity of ``threshold`` or more.

    The joint likelihood of how many registers are greater, less and equal
    depends on the similarity and on the sizes of the sets, which are known.
    """
    greater, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = a.shape[1] - greater - less
    share = (n_a / (n_a + n_b))[:, None]
    top = np.minimum(n_a, n_b)[:, None] / np.maximum(n_a, n_b)[:, None]
    j = np.append(np.linspace(0, 1, 41)[:-1], threshold)[None, :] * np.where(top > threshold, 1.0, top)
    j = np.minimum(np.concatenate([j, top], 1), top)

    def chance(x):
        return np.maximum(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-9)

    up, down = chance(share - (1 - share) * j), chance((1 - share) - share * j)
    likelihood = greater * np.log(up) + less * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-9))
    best = likelihood.max(1)
    reach = np.where(j >= np.minimum(threshold, top), likelihood, -np.inf).max(1)
    return (top[:, 0] < threshold) | (best - reach > LESS_LIKELY)


def _sketches(texts: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            data, offsets = utf8_batch(batch.column("text"))
            for a, b in chunks(offsets):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows: list = [None] * (b - a)
                if full:
                    for i, row in zip(full, registers([sets[i] for i in full])):
                        rows[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(UID).slice(a, b - a), batch.column("doc_id").slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()), pa.array(rows, pa.binary())],
                    names=[UID, "doc_id", "n_shingles", "digest", "registers"],
                )

    return texts.mapInArrow(run, f"{UID} long, doc_id long, n_shingles long, digest binary, registers binary")


def _sets(texts: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_batch(batch.column("text"))
            for a, b in chunks(offsets):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)
                bounds = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(UID).slice(a, b - a), pa.ListArray.from_arrays(pa.array(bounds), values)], names=[UID, "shingles"]
                )

    return texts.mapInArrow(run, f"{UID} long, shingles array<long>")


def _likely(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, n_a, n_b, registers_a, registers_b) that share a band and whose registers do not speak against the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("registers_a", "registers_b")]
            sizes = [np.asarray(batch.column(c), np.float64) for c in ("n_a", "n_b")]
            a, b = (r.reshape(-1, BANDS, ROWS) for r in rows)
            stay = (a == b).all(2).any(1) & ~unlikely(*rows, *sizes, threshold)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(stay)) for c in ("a", "b")], names=["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "registers_a", "registers_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component of the edges (a, b), by alternating large and small stars.

    A node's neighbours are only ever reduced to their least; nodes with very
    many neighbours are joined like any skewed key. Each step is written to the
    shared folder, and at most a number of steps logarithmic in the size of a
    component is taken.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.where("u <> v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        current = stored(small.where("u <> v").distinct(), "small-star")
        now = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _feasible(percent: int, shared: Column, n: Column, other: Column) -> Column:
    """Whether sets of n and of ``other`` elements with at most ``shared`` in common can reach the threshold."""
    return F.lit(100) * shared >= F.lit(percent) * (n + other - shared)


def _narrowed(waiting: DataFrame, percent: int) -> DataFrame:
    """The members of groups that could reach the threshold with a member of another component of their group.

    ``most`` bounds what a set shares with any other of the group. Per group
    and size of set the greatest such bound is known, and whether there is
    more than one component; so no pairs of members are formed.
    """
    sizes = waiting.groupBy(F.col("key").alias("k"), F.col("n").alias("n2")).agg(
        F.max("most").alias("most2"), F.min("root").alias("root1"), F.max("root").alias("root2")
    )
    met = (
        (F.col("key") == F.col("k")) & ((F.col("root1") != F.col("root")) | (F.col("root2") != F.col("root")))
        & _feasible(percent, F.least("most", "most2"), F.col("n"), F.col("n2"))
    )
    return waiting.join(sizes, met, "left_semi")


def _prefixes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, uid, n, most, root): the first shingles of each set that another member has, the rarest first.

    All sets are put in one order of shingles, by holders among the members.
    If the first shingle that two sets share stands at place i of one and j of
    the other (from 0), they share n - i and n2 - j at most, so it is among the
    first n - ceil(threshold * n) + 1 of both if they can be linked: no link is
    lost. Sets edited so much that these are all their own meet nobody.
    """
    each = sets.join(members.select(UID), UID, "left_semi").select(UID, F.explode("shingles").alias("key"))
    held = stored(each, "member-shingles")
    counted = held.join(held.groupBy("key").agg(F.count(F.lit(1)).alias("holders")), "key")
    place = F.row_number().over(Window.partitionBy(UID).orderBy("holders", "key")) - 1
    ranked = counted.withColumn("place", place).join(members, UID)
    return ranked.where((F.col("holders") > 1) & (F.col("place") <= F.expr(f"n - ({percent} * n + 99) div 100"))).select(
        "key", UID, "n", (F.col("n") - F.col("place")).alias("most"), "root"
    )


def link(texts: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketches of ``texts``, and (uid, root) of the representatives of different shingle sets that are linked.

    Rows with the same set are represented by the one with the least uid.
    Representatives that share a band meet in its bucket. Members whose
    shingles that no other member of any bucket has are so many that they
    cannot reach the threshold with a member of another component are dropped;
    this is exact, forms no pairs, and takes apart families of copies that were
    edited much. In a first round, over a few bands, the member of each bucket
    with the fewest shingles of its own (the middle of a family) is compared
    with the others. The members that could still be linked to another
    component over any band then meet by the rarest of their shingles
    (``_prefixes``) instead of by buckets, so members of a family that cannot
    reach the threshold do not meet. Round by round a few members of each such
    group (the pivots, from the smallest components) are compared with those of
    the group that are not in their component, share a band with them and can
    reach the threshold, and leave the group; a group is done when no members
    of different components are left that could be linked. So pairs within a
    component are not formed, but no pair that could join two components is
    left out, however large a family is.
    """
    sketches = stored(_sketches(texts, n), "sketches")
    chosen = sketches.where("n_shingles > 0").groupBy("digest").agg(F.min(UID).alias(UID)).select(UID)
    one_each = stored(sketches.join(chosen, UID).select(UID, F.col("n_shingles").alias("n"), "registers"), "representatives")
    lonely = (
        _banded(one_each, BANDS).groupBy("bucket").agg(F.min(UID).alias(UID), F.count(F.lit(1)).alias("members")).where("members = 1")
        .groupBy(UID).agg(F.count(F.lit(1)).alias("alone"))
    )
    candidates = one_each.join(lonely, UID, "left").where(F.coalesce("alone", F.lit(0)) < BANDS).drop("alone")
    sets = stored(_sets(texts.join(candidates.select(UID), UID).select(UID, "text"), n), "sets")
    own = (
        sets.select(UID, F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.min(UID).alias(UID), F.count(F.lit(1)).alias("holders"))
        .where("holders = 1").groupBy(UID).agg(F.count(F.lit(1)).alias("own"))
    )
    met = stored(candidates.join(own, UID, "left").withColumn("own", F.coalesce("own", F.lit(0))).withColumn("root", F.col(UID)), "met")
    search = _Search(met, sets, percent)
    search.first_round(FIRST_BANDS)
    search.all_rounds()
    if search.roots is None:
        return sketches, one_each.select(UID, F.col(UID).alias("root")).limit(0)
    return sketches, search.roots.withColumnRenamed("node", UID)


def _banded(representatives: DataFrame, bands: int) -> DataFrame:
    """A row per representative and band, with the band's bucket in place of the registers."""
    buckets = [F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(bands)]
    return representatives.withColumn("bucket", F.explode(F.array(*buckets))).drop("registers")


class _Search:
    """Links between representatives (uid, n, own, root, registers) whose sets are in ``sets``."""

    def __init__(self, met: DataFrame, sets: DataFrame, percent: int):
        self.met, self.sets, self.percent = met, sets, percent
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None

    def _in_buckets(self, rows: DataFrame, bands: int) -> DataFrame:
        keyed = _banded(rows, bands).withColumn("most", F.col("n") - F.col("own"))
        return _narrowed(keyed.select(F.col("bucket").alias("key"), UID, "n", "most", "own", "root"), self.percent)

    def first_round(self, bands: int) -> None:
        """Compare the middle of each bucket of the first bands with the others of the bucket."""
        waiting = stored(self._in_buckets(self.met, bands), "waiting")
        middles = waiting.groupBy("key").agg(F.min(F.struct("own", UID)).alias("best"))
        self._compare(waiting, stored(middles.select("key", F.col(f"best.{UID}").alias("pivot")), "pivots"))

    def all_rounds(self) -> None:
        """Go on, by rare shingles, until no members of different components are left that share a band and could be linked."""
        left = stored(self._in_buckets(self._rooted(self.met), BANDS), "left")
        members = _narrowed(left, self.percent).select(UID, "n", "root").distinct()
        waiting = _narrowed(stored(_prefixes(stored(members, "members"), self.sets, self.percent), "prefixes"), self.percent)
        order = Window.partitionBy("key").orderBy("size", "best")
        while True:
            # once more, as those that went may have been the only chance of others
            waiting = stored(_narrowed(stored(waiting, "narrowed"), self.percent), "waiting")
            per_root = waiting.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(-F.col("most"), UID)).alias("best"))
            pivots = per_root.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
            pivots = stored(pivots.select("key", F.col(f"best.{UID}").alias("pivot")), "pivots")
            if not pivots.limit(1).count():
                return
            fresh = self._compare(waiting, pivots)
            waiting = waiting.join(pivots.withColumnRenamed("pivot", UID), ["key", UID], "left_anti")
            waiting = _narrowed(self._rooted(waiting) if fresh else waiting, self.percent)

    def _rooted(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows
        found = rows.drop("root").join(self.roots.withColumnRenamed("node", UID), UID, "left")
        return found.withColumn("root", F.coalesce("root", UID)).select(*rows.columns)

    def _compare(self, waiting: DataFrame, pivots: DataFrame) -> bool:
        """Confirm links of the pivots with members of their group in other components; whether there are any."""
        percent = self.percent
        of_pivot = waiting.join(pivots, (waiting[UID] == pivots["pivot"]) & (waiting["key"] == pivots["key"])).select(
            pivots["key"].alias("k"), "pivot", F.col("n").alias("n2"), F.col("most").alias("most2"), F.col("root").alias("root2")
        )
        met = (
            (F.col("key") == F.col("k")) & (F.col("root") != F.col("root2"))
            & _feasible(percent, F.least("most", "most2"), F.col("n"), F.col("n2"))
        )
        pairs = waiting.join(of_pivot, met).select(F.least("pivot", UID).alias("a"), F.greatest("pivot", UID).alias("b")).distinct()
        side = lambda x: self.met.select(F.col(UID).alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"registers_{x}"))
        likely = _likely(pairs.join(side("a"), "a").join(side("b"), "b"), percent / 100)
        full_set = lambda x: self.sets.select(F.col(UID).alias(x), F.col("shingles").alias(f"shingles_{x}"))
        both = F.size(F.array_intersect("shingles_a", "shingles_b"))
        found = stored(
            likely.join(full_set("a"), "a").join(full_set("b"), "b")
            .where(F.lit(100) * both >= F.lit(percent) * (F.size("shingles_a") + F.size("shingles_b") - both)).select("a", "b"),
            "links",
        )
        if not found.limit(1).count():
            return False
        self.links = found if self.links is None else self.links.unionByName(found)
        self.roots = components(self.links)
        return True


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: weft_uid, doc_id, n_shingles, component_id and kept.

    Words are runs of characters other than ASCII white space, with A-Z in
    lower case. A row's set is its distinct shingles of n words; with fewer
    words the whole sequence is the only one, and without words (null or empty
    text) it is empty and linked with nothing. Rows whose sets have 100 *
    intersection >= percent * union are linked; component_id is the smallest
    doc_id of all rows reachable over links, and the row that has it is kept
    (of repeated rows the first; of rows without any doc_id the first). An
    empty table gives no rows; other columns are ignored.

    Every link is confirmed on the full sets. Links are looked for among pairs
    that share a band of registers, see ``BANDS``.
    """
    texts = keyed_texts(docs)
    sketches, roots = link(texts, n, percent)
    class_of = sketches.where("n_shingles > 0").groupBy("digest").agg(F.min(UID).alias("one"))
    class_root = class_of.join(roots, F.col("one") == F.col(UID), "left").select("digest", F.coalesce("root", "one").alias("root"))
    rows = stored(
        sketches.select(UID, "doc_id", "n_shingles", "digest").join(class_root, "digest", "left")
        .select(UID, "doc_id", "n_shingles", F.coalesce("root", UID).alias("root")),
        "rooted",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", UID)).alias("first")
    return rows.join(rows.groupBy("root").agg(first), "root").select(
        UID, "doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), (F.col(UID) == F.col(f"first.{UID}")).alias("kept")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; a column named weft_uid is refused."""
    docs = as_scan(docs)
    return without(docs, stored(near_duplicates(docs, n, percent).where(~F.col("kept")).select(UID), "gone"))
