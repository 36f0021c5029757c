"""Suffix-array dedup on bytes: strings of k bytes that start anywhere else are removed.

The suffixes of a bucket are sorted deep-shallow: a multikey quicksort, eight
bytes at a time, down to a shallow depth, and blind tries for the groups that
still have a prefix in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import UID, chunks, keyed_texts, mix64, ragged, utf8_batch
from .windows import Kind, covered, ranges_by_text, refine, repeated_windows, true_runs

SHALLOW = 256
BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64))


def _symbols(data, offsets):
    return BYTE_HASH[data], offsets, None


class BlindTrie:
    """A trie over suffixes of ``text`` that keeps only branching depths and bytes.

    A suffix is led down by its bytes at the branching depths alone, blind to
    those between, and compared once with a suffix found there; that gives the
    depth at which it branches off. Two suffixes that agree in the first
    ``depth`` bytes share a leaf.
    """

    def __init__(self, text: bytes, depth: int):
        self.text, self.depth, self.root = text, depth, None

    def add(self, start: int, known: int) -> tuple[int, int]:
        """Add the suffix at ``start``, which has ``known`` bytes in common with all others; the suffix it was compared with
        and how many bytes they share, not counted beyond the end of the text (-1, 0 for the first)."""
        if self.root is None:
            self.root = start
            return -1, 0
        node = self.root
        while isinstance(node, list):
            at, branches, some = node
            node = branches.get(self.text[start + at] if start + at < len(self.text) else -1, some)
        other = node
        shared = common_prefix(self.text, start, other, known)
        if shared < self.depth:
            self._insert(start, other, shared)
        return other, shared

    def _insert(self, start: int, other: int, shared: int) -> None:
        byte = lambda s: self.text[s + shared] if s + shared < len(self.text) else -1
        parent, node, key = None, self.root, None
        while isinstance(node, list) and node[0] < shared:
            key = self.text[start + node[0]] if start + node[0] < len(self.text) else -1
            parent, node = node, node[1].get(key)
            if node is None:
                node = other
                break
        if isinstance(node, list) and node[0] == shared:
            node[1][byte(start)] = start
            return
        made = [shared, {byte(other): node, byte(start): start}, other]
        if parent is None:
            self.root = made
        else:
            parent[1][key] = made


def common_prefix(text: bytes, a: int, b: int, known: int) -> int:
    """How many bytes the suffixes at ``a`` and ``b`` share, at least ``known``; it looks at spans that double."""
    step, limit = 64, len(text) - max(a, b)
    while known < limit:
        size = min(step, limit - known)
        x, y = text[a + known : a + known + size], text[b + known : b + known + size]
        if x != y:
            differ = np.frombuffer(x, np.uint8) != np.frombuffer(y, np.uint8)
            return known + int(differ.argmax())
        known += size
        step *= 2
    return known


def _eight(data: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as one number, so that numbers sort as the bytes do."""
    values, width = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64), 1
    while width < 8:
        values = (values[:-width] << np.uint64(8 * width)) | values[width:]
        width *= 2
    return values


def _repeated(k: int, shallow: int = SHALLOW):
    def run(packed: list[bytes], bucket: np.ndarray) -> list[list[tuple[int, int]]]:
        text = b"".join(packed)
        offsets = np.append(0, np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed))))
        windows = np.diff(offsets) - k + 1
        start = ragged(offsets[:-1], windows)
        group = np.repeat(bucket.astype(np.int64), windows)
        alive = np.arange(len(start))
        eight = _eight(np.frombuffer(text, np.uint8))
        depth = 0
        while depth + 8 <= min(shallow, k) and len(alive):
            group, alive = refine(group, eight[start[alive] + depth], alive)
            depth += 8
        marks = bytearray(len(start))
        if len(alive):
            first_window = np.append(0, np.cumsum(windows))
            mine = np.searchsorted(first_window, alive, side="right") - 1  # the string of each window
            cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            ends = np.append(cuts[1:], len(group))
            order = np.argsort(np.minimum.reduceat(alive, cuts), kind="stable")
            # plain numbers: most groups have two members
            members, begins, stops = alive.tolist(), start[alive].tolist(), first_window[mine + 1].tolist()
            for a, b in zip(cuts[order].tolist(), ends[order].tolist()):
                _deep(text, k, depth, members[a:b], begins[a:b], stops[a:b], marks)
        return true_runs(np.frombuffer(marks, bool), np.append(0, np.cumsum(windows)))

    return run


def _deep(text, k, depth, members, begins, stops, marks) -> None:
    """Order the suffixes of one group, which share ``depth`` bytes, in a blind trie, and mark those that share k bytes.

    ``begins`` has where the suffixes begin, ``stops`` the window after the last one of their strings. What two suffixes share
    beyond k bytes marks the windows behind them too, so a long repeat costs one comparison and its other groups are done.
    """
    if all([marks[window] for window in members]):
        return
    trie = BlindTrie(text, k)
    of = dict(zip(begins, zip(members, stops)))
    for s in begins:
        other, shared = trie.add(s, depth)
        if other >= 0 and shared >= k:
            pair = of[s], of[other]
            n = min(shared - k + 1, *[stop - window for window, stop in pair])
            for window, _ in pair:
                marks[window : window + n] = b"\x01" * n


def remove_repeated(docs: DataFrame, k: int = 400, shallow: int = SHALLOW) -> DataFrame:
    """Per row of ``docs``: weft_uid, doc_id, n_bytes, n_removed, n_spans (maximal removed runs), spans (array of begin and
    end) and kept (binary, the remaining bytes).

    A text is its UTF-8 bytes; each byte in a string of k bytes that also
    starts anywhere else, in this or another row, is removed, judged on the
    input. Matches never cross texts. Null and empty texts have no bytes;
    texts shorter than k lose nothing; repeated rows are documents of their
    own; an empty table gives no rows; other columns are ignored. What stays
    may begin or end within a character, so it is binary.
    """
    grams = tuple(m for m in (128, 320, 384) if m < k) + (k,)
    kind = Kind(k, grams, _symbols, _repeated(k, shallow))
    texts = keyed_texts(docs)
    ranges = repeated_windows(texts.select(UID, "text"), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_batch(batch.column("text"))
            lists = batch.column("ranges")
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            places, flat = np.append(0, np.cumsum(counts)), lists.flatten()
            for a, b in chunks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                gone = covered(flat.slice(places[a], places[b] - places[a]), counts[a:b], at, k)
                spans = true_runs(gone, at)
                left, kept_at = part[~gone].tobytes(), np.append(0, np.cumsum(~gone))[at].tolist()
                kept = [left[i:j] for i, j in zip(kept_at[:-1], kept_at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(UID).slice(a, b - a), batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at)),
                     pa.array(np.diff(at) - np.diff(kept_at)), pa.array([len(s) for s in spans], pa.int64()),
                     pa.array([[{"begin": x, "end": y} for x, y in s] for s in spans], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.binary())],
                    names=[UID, "doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
                )

    return ranges_by_text(texts, ranges).select(UID, "doc_id", "text", "ranges").mapInArrow(
        run, f"{UID} long, doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<begin: long, end: long>>, kept binary"
    )
