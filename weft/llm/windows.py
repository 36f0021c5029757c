"""Finding every window of k symbols that also starts elsewhere, by super-k-mers.

Used with words (``substring_dedup``) and with bytes (``suffix_dedup``). The
minimiser of a window is the least hash among its grams of m symbols. Windows
that are equal have equal minimisers, and consecutive windows mostly share
one, so a run of them (a super-k-mer) travels as one string to the bucket of
its minimiser, where equal windows are found by their content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UID, chunks, mix64, ragged, stored, utf8_batch

# A bucket with more different strings is divided by the minimisers of longer grams.
HOT_STRINGS = 512
# Windows of one super-k-mer at most; only repetitive texts have longer ones.
LONGEST = 1024
# Symbols that are hashed at once within one long text.
TILE = 1 << 22


class Kind(NamedTuple):
    """How texts become symbols. symbols: bytes and text offsets to (hash per symbol, symbol offsets per text, and the
    byte range of each symbol or None if symbols are bytes)."""

    k: int
    grams: tuple[int, ...]  # lengths of the grams, level by level; the last is k
    symbols: Callable
    repeated: Callable  # (packed strings, their bucket numbers) to a list of ranges of repeated windows per string


def gram_hashes(symbols: np.ndarray, m: int) -> np.ndarray:
    """Hashes of all grams of m symbols, put together from grams of 1, 2, 4, ... symbols."""
    power, have, out, length = symbols, 1, None, 0
    while True:
        if m & have:
            if out is None:
                out, length = power, have
            else:
                n = len(symbols) - length - have + 1
                out = out[:n] * np.uint64(0xD6E8FEB86659FD93 + 2 * have) + power[length : length + n]
                length += have
        if 2 * have > m:
            return mix64(out + np.uint64(m))
        power = power[:-have] * np.uint64(0xA0761D6478BD642F + 2 * have) + power[have:] if len(power) > have else power[:0]
        have *= 2


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least of every w consecutive values, from running minima within blocks of w."""
    n = len(values) - w + 1
    if w == 1 or n <= 0:
        return values[: max(n, 0)]
    padded = np.full(-(-len(values) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def super_kmers(symbols: np.ndarray, offsets: np.ndarray, k: int, m: int) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, minimiser, inner) of each run of windows with the same minimiser.

    inner is 1 where the minimiser moves on to another place within the run;
    only then can the run itself hold equal windows. With m = k the windows of
    a run are equal (one symbol repeated); the first then stands for itself, so
    that a run of several counts twice.
    """
    windows = np.maximum(np.diff(offsets) - k + 1, 0)
    if not windows.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none
    grams = gram_hashes(symbols, m)
    # the low bits hold the place, so the least is the leftmost among equal grams
    mask = np.uint64((1 << int(len(grams)).bit_length()) - 1)
    place = sliding_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), k - m + 1) & mask
    least = grams[place]
    moved = np.append(0, np.cumsum(place[1:] != place[:-1]))
    change = np.ones(len(least), bool)
    change[1:] = least[1:] != least[:-1]
    some = windows > 0
    begin, end = offsets[:-1][some], (offsets[:-1] + windows)[some]
    change[begin] = True
    inside = np.zeros(len(least) + 1, np.int8)
    inside[begin] = 1
    np.add.at(inside, end, -1)
    starts = np.flatnonzero(change & (np.cumsum(inside[:-1]) > 0))
    text = np.searchsorted(begin, starts, side="right") - 1
    sizes = np.minimum(np.append(starts[1:], len(least)), end[text]) - starts
    minimiser, inner = least[starts], (moved[starts + sizes - 1] > moved[starts]).astype(np.int64)
    if len(sizes) and sizes.max() > LONGEST:
        parts = -(-sizes // LONGEST)
        which = np.repeat(np.arange(len(sizes)), parts)
        step = (ragged(np.zeros(len(parts), np.int64), parts)) * LONGEST
        starts, sizes = starts[which] + step, np.minimum(sizes[which] - step, LONGEST)
        text, minimiser, inner = text[which], minimiser[which], inner[which]
    if m == k and (sizes > 1).any():
        which = np.repeat(np.arange(len(sizes)), np.where(sizes > 1, 2, 1))
        rest = np.append(False, which[1:] == which[:-1])
        starts, sizes = starts[which] + rest, np.where(rest, sizes[which] - 1, 1)
        text, minimiser, inner = text[which], minimiser[which], inner[which]
    text = np.flatnonzero(some)[text]
    return text, starts - offsets[text], sizes, minimiser, inner


def _tiled(symbols, offsets, k, m):
    """``super_kmers``, a long text tile by tile."""
    if len(offsets) > 2 or len(symbols) <= 2 * TILE:
        return super_kmers(symbols, offsets, k, m)
    found = []
    for a in range(0, max(1, len(symbols) - k + 1), TILE):
        part = symbols[a : a + TILE + k - 1]
        text, first, n, minimiser, inner = super_kmers(part, np.array([0, len(part)]), k, m)
        found.append((text, first + a, n, minimiser, inner))
    return tuple(np.concatenate(x) for x in zip(*found))


def _cut(data: np.ndarray, spans, symbol_offsets: np.ndarray, text, first, n, k, m) -> list[bytes]:
    """The strings of runs of windows with minimisers of m symbols; words are laid end to end with one space between.

    With m = k a run is one window several times and its string that window, whatever its length.
    """
    a = symbol_offsets[text] + first
    b = a + (n + k - 1 if m < k else k)
    if spans is None:
        raw = data.tobytes()
        return [raw[i:j] for i, j in zip(a.tolist(), b.tolist())]
    begin, end = spans
    raw = data.tobytes()
    # white space between words as it is in the text; only longer runs, or other white space, need words to be joined
    plain = np.append(0, np.cumsum(np.append((begin[1:] - end[:-1] == 1) & (data[end[:-1]] == 0x20), True) if len(begin) else []))
    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        if plain[j - 1] - plain[i] == j - 1 - i:
            out.append(raw[begin[i] : end[j - 1]])
        else:
            out.append(b" ".join(raw[x:y] for x, y in zip(begin[i:j].tolist(), end[i:j].tolist())))
    return out


MARKS = {"key": pa.int64(), UID: pa.int64(), "first": pa.int32(), "n": pa.int32(), "inner": pa.int32()}
STRINGS = MARKS | {"weight": pa.int32(), "packed": pa.binary()}
RANGES = {UID: pa.int64(), "lo": pa.int32(), "hi": pa.int32()}
_SQL = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}


def _record(columns: list, fields: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values())], names=list(fields))


def _schema(fields: dict) -> str:
    return ", ".join(f"{name} {_SQL[t]}" for name, t in fields.items())


def mark(texts: DataFrame, kind: Kind) -> DataFrame:
    """(key, uid, first, n, inner) of all super-k-mers of ``texts`` (uid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = np.asarray(batch.column(0))
            data, offsets = utf8_batch(batch.column(1))
            for a, b in chunks(offsets):
                hashes, at, _ = kind.symbols(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                text, first, n, minimiser, inner = _tiled(hashes, at, kind.k, kind.grams[0])
                if len(text):
                    yield _record([minimiser.view(np.int64), uids[a:b][text], first, n, inner], MARKS)

    return texts.mapInArrow(run, _schema(MARKS))


def pack(texts: DataFrame, kind: Kind) -> DataFrame:
    """The strings of the marked runs of ``texts`` (uid, text, runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = np.asarray(batch.column(0))
            data, offsets = utf8_batch(batch.column(1))
            runs = batch.column(2)
            counts = np.append(0, np.cumsum(np.asarray(runs.value_lengths(), np.int64)))
            flat = runs.flatten()
            key, first, n, inner = (np.asarray(flat.field(i)) for i in range(4))
            for a, b in chunks(offsets, 1 << 20):
                part = data[offsets[a] : offsets[b]]
                _, at, spans = kind.symbols(part, offsets[a : b + 1] - offsets[a])
                x, y = counts[a], counts[b]
                text = np.repeat(np.arange(b - a), np.diff(counts[a : b + 1]))
                packed = _cut(part, spans, at, text, first[x:y].astype(np.int64), n[x:y].astype(np.int64), kind.k, kind.grams[0])
                for i in range(0, y - x, 8192):
                    j = min(i + 8192, y - x)
                    of = slice(x + i, x + j)
                    yield _record([key[of], uids[a:b][text[i:j]], first[of], n[of], inner[of], np.ones(j - i, np.int32), packed[i:j]], STRINGS)

    return texts.mapInArrow(run, _schema(STRINGS))


def divide(strings: DataFrame, kind: Kind, level: int) -> DataFrame:
    """The strings cut anew by the minimisers of the grams of ``level``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, firsts, weights = (np.asarray(batch.column(c)) for c in (UID, "first", "weight"))
            data, offsets = utf8_batch(batch.column("packed"))
            for a, b in chunks(offsets, 1 << 20):
                part = data[offsets[a] : offsets[b]]
                hashes, at, spans = kind.symbols(part, offsets[a : b + 1] - offsets[a])
                text, first, n, minimiser, inner = super_kmers(hashes, at, kind.k, kind.grams[level])
                packed = _cut(part, spans, at, text, first, n, kind.k, kind.grams[level])
                yield _record([minimiser.view(np.int64), uids[a:b][text], firsts[a:b][text] + first, n, inner, weights[a:b][text], packed], STRINGS)

    return strings.select(UID, "first", "weight", "packed").mapInArrow(run, _schema(STRINGS))


def _buckets(kind: Kind):
    """Sort the windows of whole buckets, as many together as make a few MB."""

    def solve(rows: list) -> pa.RecordBatch:
        keys = np.array([r[0] for r in rows])
        bucket = np.cumsum(np.append(0, keys[1:] != keys[:-1]))
        found = kind.repeated([r[4] for r in rows], bucket)
        out = [(r[1], r[2] + a, r[2] + b) for r, ranges in zip(rows, found) if r[3] < 2 for a, b in ranges]
        return _record([[r[i] for r in out] for i in range(3)], RANGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", UID, "first", "weight", "packed"))):
                if size > 2 << 20 and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield solve(rows)

    return run


def repeated_windows(texts: DataFrame, kind: Kind) -> DataFrame:
    """(uid, lo, hi): ranges of windows of ``texts`` (uid, text) whose content also starts anywhere else; every such
    window is in some range, no other is.

    1. Every super-k-mer is marked by its minimiser. One whose minimiser has no
       other place anywhere cannot hold a repeated window and goes no further.
    2. The others travel as strings. Equal strings are counted (summed before
       the shuffle): windows of a string that occurs twice are repeated.
    3. Of the different strings, those with a minimiser in common meet in its
       bucket, where windows are compared by content.
    4. A bucket with more than HOT_STRINGS different strings (a phrase that
       very many texts have, each in a context of its own) is divided: its
       strings are cut anew by the minimisers of longer grams and go through
       2 to 4 again. The last grams are whole windows, whose strings are equal
       if the windows are, so this ends.
    """
    marks = stored(mark(texts, kind), "marks")
    # both sides of the joins by key are written, so that Spark can split the rows of a hot key
    shared = marks.groupBy("key").agg((F.count(F.lit(1)) + F.max("inner")).alias("holders")).where("holders > 1")
    runs = marks.join(stored(shared, "shared"), "key").groupBy(UID).agg(F.collect_list(F.struct("key", "first", "n", "inner")).alias("runs"))
    strings = stored(pack(texts.join(runs, UID), kind), "strings")
    ranges = None
    for level in range(len(kind.grams)):
        strings = strings.withColumn("digest", F.unhex(F.md5("packed")))
        found = F.min(F.struct(UID, "first", "n", "key", "inner")).alias("one")
        different = stored(
            strings.groupBy("digest").agg(found, F.min("packed").alias("packed"), F.sum("weight").cast("int").alias("total"))
            .select("digest", "one.*", "packed", F.least(F.lit(2), F.col("total")).alias("weight")),
            "different",
        )
        twice = different.where("weight > 1").select("digest")
        whole = strings.where("weight < 2").select("digest", UID, "first", "n").join(twice, "digest").select(
            UID, F.col("first").alias("lo"), (F.col("first") + F.col("n")).alias("hi")
        )
        ranges = whole if ranges is None else ranges.unionByName(whole)
        if level + 1 == len(kind.grams):
            break
        sizes = different.groupBy("key").agg(F.count(F.lit(1)).alias("strings"), F.max("inner").alias("within")).where("strings + within > 1").drop("within")
        sizes = stored(sizes, "sizes")
        mixed = different.drop("digest").join(sizes, "key")
        bucketed = mixed.where(F.col("strings") <= HOT_STRINGS).drop("strings")
        ranges = ranges.unionByName(
            bucketed.repartition("key").sortWithinPartitions("key", UID, "first").select("key", UID, "first", "weight", "packed")
            .mapInArrow(_buckets(kind), _schema(RANGES))
        )
        hot = mixed.where(F.col("strings") > HOT_STRINGS)
        if not sizes.where(F.col("strings") > HOT_STRINGS).limit(1).count():
            break
        strings = stored(divide(hot, kind, level + 1), "strings")
    return ranges


def ranges_by_text(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """``texts`` with their ranges as an array (null if there are none)."""
    return texts.join(ranges.groupBy(UID).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), UID, "left")


def covered(ranges: pa.Array, counts: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Which symbols (of texts with the given symbol offsets) are in a repeated window; counts: ranges per text."""
    lo, hi = (np.asarray(ranges.field(i), np.int64) for i in range(2))
    base = np.repeat(offsets[:-1], counts)
    steps = np.zeros(int(offsets[-1]) + 1, np.int32)
    np.add.at(steps, base + lo, 1)
    np.add.at(steps, base + hi + k - 1, -1)
    return np.cumsum(steps[:-1]) > 0


def refine(group: np.ndarray, value: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort by (group, value), given rising groups; the new groups, without those of one member.

    Only groups whose members differ are sorted: strings that share much agree nearly everywhere.
    """
    if not len(alive):
        return group, alive
    edge = np.append(True, group[1:] != group[:-1])
    first = np.flatnonzero(edge)
    differs = np.append(False, value[1:] != value[:-1]) & ~edge
    mixed = np.repeat(np.logical_or.reduceat(differs, first), np.diff(np.append(first, len(group))))
    at = np.flatnonzero(mixed)
    if len(at):
        order = at[np.lexsort((value[at], group[at]))]
        alive, value = alive.copy(), value.copy()
        alive[at], value[at] = alive[order], value[order]
    fresh = edge | np.append(True, value[1:] != value[:-1])
    number = np.cumsum(fresh) - 1
    several = np.bincount(number)[number] > 1
    return number[several], alive[several]


def true_runs(hit: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per text the ranges [a, b) of consecutive true values, counted from its start."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[offsets] = True
    first = np.flatnonzero(hit & (np.append(True, ~hit[:-1]) | edge[:-1]))
    last = np.flatnonzero(hit & (np.append(~hit[1:], True) | edge[1:])) + 1
    text = np.searchsorted(offsets, first, side="right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    for t, a, b in zip(text.tolist(), (first - offsets[text]).tolist(), (last - offsets[text]).tolist()):
        out[t].append((a, b))
    return out
