"""Substring dedup on words: windows of consecutive words that occur anywhere else are removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UID, chunks, keyed_texts, ragged, span_hashes, utf8_batch
from .windows import Kind, covered, ranges_by_text, refine, repeated_windows, true_runs

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end in texts laid end to end, and the word offsets per text."""
    white = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = white[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = white[1:]
    begin = np.flatnonzero(~white & (before | edge[:-1]))
    end = np.flatnonzero(~white & (after | edge[1:])) + 1
    return begin, end, np.searchsorted(begin, offsets)


def _symbols(data, offsets):
    begin, end, at = words_of(data, offsets)
    return span_hashes(data, begin, end), at, (begin, end)


def _repeated(k: int):
    def run(packed: list[bytes], bucket: np.ndarray) -> list[list[tuple[int, int]]]:
        """Windows as rows of word numbers: sorted by the first words until they differ, the rest by all their words."""
        numbers: dict[bytes, int] = {}
        split = [p.split(b" ") for p in packed]
        words = np.array([numbers.setdefault(w, len(numbers)) for s in split for w in s], np.int64)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        offsets = np.append(0, np.cumsum(sizes))
        windows = sizes - k + 1
        start = ragged(offsets[:-1], windows)
        group = np.repeat(bucket.astype(np.int64), windows)
        alive = np.arange(len(start))
        for j in range(4):
            group, alive = refine(group, words[start[alive] + j], alive)
        rows = np.column_stack([group, *(words[start[alive] + j] for j in range(4, k))]) if len(alive) else np.zeros((0, k))
        if len(alive):
            rows = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 8))).ravel()
            _, which, counts = np.unique(rows, return_inverse=True, return_counts=True)
            alive = alive[counts[which] > 1]
        hit = np.zeros(len(start), bool)
        hit[alive] = True
        return true_runs(hit, np.append(0, np.cumsum(windows)))

    return run


def remove_repeated(docs: DataFrame, k: int = 35) -> DataFrame:
    """Per row of ``docs``: weft_uid, doc_id, n_words, n_removed and kept_text, the words that stay joined by one space.

    Words are runs of characters other than ASCII white space. Each word in a
    window of k consecutive words that also starts anywhere else (in this or
    another row) is removed; windows are judged on the input. Null and empty
    texts have no words; a text of fewer than k words loses nothing; repeated
    rows are documents of their own, so they lose all words in windows; an
    empty table gives no rows; other columns are ignored.
    """
    grams = tuple(m for m in (8, 24, 32) if m < k) + (k,)
    kind = Kind(k, grams, _symbols, _repeated(k))
    texts = keyed_texts(docs)
    ranges = repeated_windows(texts.select(UID, "text"), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_batch(batch.column("text"))
            lists = batch.column("ranges")
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            places, flat = np.append(0, np.cumsum(counts)), lists.flatten()
            for a, b in chunks(offsets):
                part = data[offsets[a] : offsets[b]]
                begin, end, at = words_of(part, offsets[a : b + 1] - offsets[a])
                gone = covered(flat.slice(places[a], places[b] - places[a]), counts[a:b], at, k)
                raw, kept = part.tobytes(), []
                first, last = begin.tolist(), end.tolist()
                for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                    stay = (np.flatnonzero(~gone[i:j]) + i).tolist()
                    kept.append(b" ".join([raw[first[w] : last[w]] for w in stay]))
                removed = np.diff(np.append(0, np.cumsum(gone))[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(UID).slice(a, b - a), batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at)),
                     pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=[UID, "doc_id", "n_words", "n_removed", "kept_text"],
                )

    return ranges_by_text(texts, ranges).select(UID, "doc_id", "text", "ranges").mapInArrow(
        run, f"{UID} long, doc_id long, n_words long, n_removed long, kept_text string"
    )
